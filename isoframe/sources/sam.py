"""Alignment records from SAM text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.functions.ordered import run_heads
from isoframe.plans.cut import discard, kept_tidily, settled, tidy
from isoframe.sources.gtf import numbered

RECORD = "file string, ord long, qname string, flag int, chrom string, tid int, pos int, mapq int, cigar string, l_qseq int, nm int, as_score int, nh int, xs string"


def header(spark: SparkSession, path: str) -> DataFrame:
    """name, tid, length of the contigs, in the order of the header."""
    lines = numbered(spark, path).where(F.col("value").startswith("@SQ"))
    rows = lines.select("file", "ord", F.regexp_extract("value", "\tSN:([^\t]+)", 1).alias("name"), F.regexp_extract("value", "\tLN:([0-9]+)", 1).cast("long").alias("length"))
    rows = rows.groupBy("name").agg(F.min(F.struct("file", "ord")).alias("at"), F.max("length").alias("length"))
    # A row for each contig.
    from pyspark.sql import Window

    return rows.select("name", (F.row_number().over(Window.orderBy("at", "name")) - 1).alias("tid"), "length")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of a SAM file or folder; absent tags are null."""
    fields = F.split("value", "\t")
    # Lines of the header have fewer fields; conditions may be evaluated on them.
    f = lambda i: F.get(fields, F.lit(i))
    tag = lambda name, kind: F.nullif(F.regexp_extract("value", f"\t{name}:{kind}:([^\t]*)", 1), F.lit(""))
    rows = numbered(spark, path).where(~F.col("value").startswith("@") & (F.length("value") > 0))
    rows = rows.select(
        "file", "ord", f(0).alias("qname"), f(1).try_cast("int").alias("flag"), f(2).alias("chrom"), (f(3).try_cast("int") - 1).alias("pos"), f(4).try_cast("int").alias("mapq"), f(5).alias("cigar"),
        F.when(f(9) == "*", 0).otherwise(F.length(f(9))).alias("l_qseq"), tag("NM", "i").cast("int").alias("nm"), tag("AS", "i").cast("int").alias("as_score"), tag("NH", "i").cast("int").alias("nh"), tag("XS", "A").alias("xs"),
    )
    # A row for each contig: records needn't be shuffled to meet theirs.
    named = F.broadcast(header(spark, path).select(F.col("name").alias("chrom"), "tid"))
    return rows.join(named, "chrom", "left").select(*(c.split()[0] for c in RECORD.split(", ")))


def write(records: DataFrame, contigs: DataFrame, path: str, by_place: bool = False, compression: str = "none") -> None:
    """Write records as SAM text without bases, after their header.

    In order of ord, or ``by_place``: by contig and place, unmapped ones last.
    Records of a read that follow one another by ord stay in one file, as reads
    of different files are different reads.  A read's length is that of a row of N, so
    text takes far more room than the records; ``compression`` is one of Spark's for
    text, and a compressed file of the folder is read by one task.
    """
    head = contigs.select(F.lit(0).alias("part"), F.col("tid").cast("long").alias("ord"), F.concat(F.lit("@SQ\tSN:"), "name", F.lit("\tLN:"), F.col("length").cast("string")).alias("value"))
    tags = [F.concat(F.lit(f"{name}:{kind}:"), F.col(c).cast("string")) for name, kind, c in (("NM", "i", "nm"), ("AS", "i", "as_score"), ("NH", "i", "nh"), ("XS", "A", "xs"))]
    fixed = ["qname", F.col("flag").cast("string"), "chrom", (F.col("pos") + 1).cast("string"), F.col("mapq").cast("string"), "cigar", F.lit("*"), F.lit("0"), F.lit("0")]
    if by_place:
        keys = [F.when(F.col("tid") >= 0, F.col("tid")).otherwise(1 << 30).cast("long"), F.col("pos").cast("long"), F.col("ord")]
    else:
        # Step by step, so that the shuffles of one are gone before the next.
        steps = settled(lambda: run_heads(kept_tidily(records.drop("file"), "records"), F.col("qname"), "first"), "records-in-runs")
        keys = [F.lit(0), F.lit(0), F.col("first")]
    body = (records if by_place else steps).select(F.lit(1).alias("part"), *(k.cast("long").alias(c) for k, c in zip(keys, ("contig", "at", "first"), strict=True)), "ord", F.concat_ws("\t", *fixed).alias("value"), F.coalesce("l_qseq", F.lit(0)).alias("n"), F.concat_ws("\t", F.lit("*"), *tags).alias("rest"))
    head = head.select("part", *(F.lit(0).cast("long").alias(c) for c in ("contig", "at", "first")), "ord", "value")
    order = ["part", "contig", "at", "first"]
    lines = head.unionByName(body, allowMissingColumns=True).repartitionByRange(*order).sortWithinPartitions(*order, "ord")
    # The rows of N aren't shuffled; the header has neither them nor the rest.
    bases = F.when(F.col("n") > 0, F.repeat(F.lit("N"), F.col("n"))).when(F.col("n").isNotNull(), "*")
    with tidy(records.sparkSession):
        lines.select(F.concat_ws("\t", "value", bases, "rest").alias("value")).write.text(path, compression=compression)
    if not by_place:
        discard(steps)
