"""Junction tables, sequence files, manifests and result tables."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.functions.ordered import filled, summed
from isoframe.params import Params
from isoframe.sources import fastq
from isoframe.sources.gtf import numbered

#: Bases of a chunk of a genome.
CHUNK = 4096
JUNCTION = "chrom string, don int, acc int, strand int, motif int, is_anno int, uniq_c int, multi_c int, max_over int"


def read_junctions(spark: SparkSession, path: str, contigs: DataFrame | None = None) -> DataFrame:
    """Junction table of nine columns, with tid from the contigs (name, tid)."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    f = F.split(F.trim("value"), r"\s+")
    names = [c.split() for c in JUNCTION.split(", ")]
    rows = lines.select(*(F.get(f, F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(names)))
    if contigs is None:
        return rows
    return rows.join(contigs.select(F.col("name").alias("chrom"), "tid"), "chrom", "left")


def junctions_from_counts(counts: DataFrame) -> DataFrame:
    """Counted junctions, in the columns of a junction table."""
    return counts.select("chrom", "don", "acc", "strand", "motif", "is_anno", "uniq_c", "multi_c", F.lit(0).alias("max_over"))


#: The lines before the rows of a junction file.
JUNCTION_HEAD = [
    "###STRAND 0:undefined, 1:+, 2:-",
    "###ANNO 0:novel, 1:annotated",
    "###MOTIF 0:non-canonical, 1:GT/AG, 2:CT/AC, 3:GC/AG, 4:CT/GC, 5:AT/AC, 6:GT/AT",
    "#CHR\tSTART\tEND\tSTRAND\tANNO\tUNIQ_C\tMULTI_C\tMOTIF",
]


def write_junctions(junctions: DataFrame, path: str) -> None:
    """Counted junctions by place, after their legends and header."""
    columns = ["chrom", "don", "acc", "strand", "is_anno", "uniq_c", "multi_c", "motif"]
    body = junctions.select(F.lit(1).alias("part"), "tid", "don", "acc", F.concat_ws("\t", *(F.col(c).cast("string") for c in columns)).alias("value"))
    head = junctions.sparkSession.createDataFrame([(0, 0, k, 0, x) for k, x in enumerate(JUNCTION_HEAD)], "part int, tid int, don int, acc int, value string")
    head.unionByName(body).orderBy("part", "tid", "don", "acc").select("value").write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, name, comment, seq of FASTA records; gzip is read, too.

    Files are cut at the line ends before ``>``, so a large one is read by many
    tasks.
    """
    raw = spark.read.option("lineSep", "\n>").text(path)
    rows = raw.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^>", "").alias("value"))
    head = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substr("value", F.length(head) + 2), r"\s", "")
    rows = rows.where(F.length(F.trim("value")) > 0)
    return rows.select(
        "file", (F.col("block") * (1 << 20) + F.col("id").bitwiseAND((1 << 33) - 1)).alias("ord"), F.regexp_extract(head, r"^(\S*)", 1).alias("name"),
        F.nullif(F.trim(F.regexp_replace(head, r"^\S*", "")), F.lit("")).alias("comment"), body.alias("seq"),
    )


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, name, comment, seq, qual; see ``sources.fastq``."""
    return fastq.read(spark, path)


def genome(spark: SparkSession, path: str) -> DataFrame:
    """chrom, chunk, bases: a genome's contigs in chunks of CHUNK bases, and one
    more, so that two bases in a row lie in one chunk.

    Lines are put in their places by running sums over ranges of the file, so
    no row carries a contig, whatever its length; a gzip file is one task's to read.
    """
    lines = numbered(spark, path).withColumn("text", F.rtrim("value"))
    is_head = F.col("text").startswith(">")
    lines = summed(lines, F.when(is_head, 0).otherwise(F.length("text")), "before")
    head = F.struct(F.regexp_extract("text", r"^>(\S*)", 1).alias("chrom"), F.col("before").alias("begin"))
    lines = filled(lines, F.when(is_head, head), "head").where(~is_head & F.col("head").isNotNull() & (F.length("text") > 0))
    placed = lines.select(F.col("head.chrom").alias("chrom"), (F.col("before") - F.col("head.begin")).alias("begin"), F.col("text").cast("binary").alias("text"))
    end = F.col("begin") + F.octet_length("text")
    # A chunk also takes the base that follows it.
    chunks = F.explode(F.sequence(F.floor(F.greatest(F.col("begin") - 1, F.lit(0)) / CHUNK), F.floor((end - 1) / CHUNK)))
    parts = placed.select("chrom", "begin", end.alias("end"), chunks.alias("chunk"), "text")
    low, high = F.greatest("begin", F.col("chunk") * CHUNK), F.least("end", (F.col("chunk") + 1) * CHUNK + 1)
    part = F.substring("text", (low - F.col("begin") + 1).cast("int"), (high - low).cast("int")).cast("string")
    parts = parts.where(high > low).select("chrom", "chunk", F.struct(low.alias("at"), part.alias("part")).alias("x"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["part"]), "")
    return parts.groupBy("chrom", "chunk").agg(joined.alias("bases"))


def replicates(text: str) -> list[list[str]]:
    """Paths of samples (split by colons) and their replicates (by commas)."""
    return [[p for p in sample.split(",") if p] for sample in text.split(":") if sample]


def manifest(text: str) -> dict[str, list[list[str]]]:
    """Read files of a manifest: for long and short reads, a number of samples,
    then the replicates of each, by commas; ``#`` begins a comment.
    """
    rows = [line.split("#")[0].strip() for line in text.splitlines()]
    rows, out = [r for r in rows if r], {}
    for kind in ("long", "short"):
        n = int(rows.pop(0)) if rows else 0
        out[kind] = [replicates(rows.pop(0).replace(":", ",").replace(" ", ","))[0] for _ in range(n)]
    return out


def params_of(settings: dict) -> Params:
    """Thresholds from the settings of a run: by their names there, or by ours."""
    names = {"aln_cov": "min_coverage", "iden_frac": "min_identity", "sec_rat": "max_second", "sup_cnt": "min_junction_count", "split_trans": "split"}
    names |= {f.name: f.name for f in fields(Params)}
    return Params(**{names[k]: v for k, v in settings.items() if k in names and v is not None})


def read_settings(spark: SparkSession, path: str) -> dict[str, object]:
    """Settings of a file of ``name: value`` lines, nested ones by their own
    names; ``#`` begins a comment.  Numbers and truths become such."""
    def value(text: str) -> object:
        text = text.strip().strip("\"'")
        if text.lower() in ("true", "false"):
            return text.lower() == "true"
        try:
            return float(text) if "." in text or "e" in text.lower() else int(text)
        except ValueError:
            return text or None

    # A file that people write.
    lines = [r["value"].split(" #")[0] for r in spark.read.text(path).collect() if not r["value"].lstrip().startswith("#")]
    pairs = [line.split(":", 1) for line in lines if ":" in line]
    return {k.strip(): value(v) for k, v in pairs if v.strip()}


def write_table(frame: DataFrame, path: str, order: list[str]) -> None:
    """Any result table as tab-separated text with a header, in order."""
    frame.orderBy(*order).write.csv(path, sep="\t", header=True)


def write_fusions(fusions: DataFrame, contigs: DataFrame, path: str) -> None:
    """Fusions, numbered by read name, one row each, with a header."""
    names = lambda side: contigs.select(F.col("tid").alias(f"{side}_tid"), F.col("name").alias(f"{side}_chr"))
    rows = fusions.join(names("left"), "left_tid").join(names("right"), "right_tid")
    strand = lambda side: F.when(F.col(f"{side}_is_rev"), "-").otherwise("+")
    # The columns of a fusion file.
    heads = ["#fusion_id", "1st_chr", "1st_strand", "st_start_site", "1st_end_site", "2nd_chr", "2nd_strand", "2nd_start_site", "2nd_end_site"]
    columns = ["qname"] + [c for side in ("left", "right") for c in (f"{side}_chr", strand(side), F.col(f"{side}_ref_start").cast("string"), F.col(f"{side}_ref_end").cast("string"))]
    body = rows.select(F.lit(1).alias("part"), "qname", F.concat_ws("\t", *columns).alias("value"))
    head = body.sparkSession.createDataFrame([(0, "", "\t".join(heads))], "part int, qname string, value string")
    head.unionByName(body).orderBy("part", "qname").select("value").write.text(path)


def write_bed(exons: DataFrame, contigs: DataFrame, path: str) -> None:
    """Novel exons (tid, start, end, kind, score, is_rev) as BED."""
    named = exons.join(contigs.select("tid", "name"), "tid")
    strand = F.when(F.col("is_rev"), "-").otherwise("+")
    rows = named.orderBy("tid", "start", "end").select("name", F.col("start") - 1, "end", F.concat("kind", F.lit("_exon")), "score", strand)
    rows.write.csv(path, sep="\t")
