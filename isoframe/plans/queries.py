"""Registered queries of the annotation operators, over the fixture tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.functions import cigar, intervals, ordered
from isoframe.operators import classify, evidence, fusion, junctions, merge, report, select, split
from isoframe.operators.transcripts import from_alignments, shown, strand
from isoframe.plans import update
from isoframe.plans.cut import kept_tidily as kept
from isoframe.plans.cut import new_path
from isoframe.plans.fixtures import alignments, parts, transcripts, view
from isoframe.params import Params
from isoframe.sources import bam, gtf, placed, sam, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Stricter than the defaults, which drop nothing of the fixture tables.
STRICT = Params(min_coverage=0.80, min_identity=0.90)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = parts(spark, sf_dir)
    return transcripts(spark, sf_dir, "read", n), transcripts(spark, sf_dir, "anno", n)


def _sj(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "fx_sj")


def _judged(spark, sf_dir, params: Params = Params()) -> DataFrame:
    reads, annotation = _pair(spark, sf_dir)
    rows = update.judged(reads, annotation, _sj(spark, sf_dir), params)
    return rows.withColumn("trans_id", F.col("ord").cast("string"))


def _bits(flags) -> F.Column:
    return F.array_join(F.transform(flags, lambda x: x.cast("int").cast("string")), "")


@query
def cigar_exons(spark, sf_dir):
    """Exons of every mapped alignment."""
    rows = from_alignments(alignments(spark, sf_dir))
    return rows.select(F.col("trans_id").cast("long").alias("qname"), "ord", F.posexplode("exons").alias("place", "x")).select("qname", "ord", "place", F.col("x.start").alias("exon_start"), F.col("x.end").alias("exon_end"))


@query
def cigar_query_len(spark, sf_dir):
    ops = cigar.ops(F.col("cigar"))
    return alignments(spark, sf_dir).select("qname", "ord", cigar.query_length(ops).alias("query_len"), cigar.reference_length(ops).alias("ref_len"), cigar.count(ops, "D", 2).alias("n_del_2"))


@query
def read_strand(spark, sf_dir):
    rows = alignments(spark, sf_dir).withColumn("xs", F.when(F.col("nh") == 2, "+").when(F.col("rec") == 3, "-"))
    return rows.select("qname", "ord", strand(F.col("xs"), F.col("flag")).alias("is_rev"))


@query
def filter_coverage(spark, sf_dir):
    return select.covered_enough(select.measured(alignments(spark, sf_dir)), STRICT).select("qname", "ord", "covered", "score")


@query
def filter_identity(spark, sf_dir):
    return select.alike_enough(select.measured(alignments(spark, sf_dir)), STRICT).select("qname", "ord", "covered", "score")


def _removal(spark, sf_dir) -> DataFrame:
    return transcripts(spark, sf_dir, "anno").where("CAST(gene_id AS INT) % 7 = 0").select("tid", "start", "end")


@query
def filter_remove_overlap(spark, sf_dir):
    return select.outside(select.measured(alignments(spark, sf_dir)), _removal(spark, sf_dir)).select("qname", "ord")


@query
def best_alignment(spark, sf_dir):
    return select.filtered(alignments(spark, sf_dir), STRICT).select("qname", "ord", "score", "second", "n_introns")


@query
def filter_full(spark, sf_dir):
    """Every step of the filter, with removal and at least one intron."""
    rows = select.filtered(alignments(spark, sf_dir), replace(STRICT, min_introns=1), _removal(spark, sf_dir))
    return rows.select("qname", "ord", "score")


@query
def junction_extract(spark, sf_dir):
    rows = alignments(spark, sf_dir)
    return junctions.extracted(rows).select("tid", "don", "acc", "is_uniq", "ord")


@query
def junction_counts(spark, sf_dir):
    rows = alignments(spark, sf_dir)
    return junctions.counted(junctions.extracted(rows)).select("tid", "don", "acc", "strand", "motif", "uniq_c", "multi_c")


@query
def transcripts_nested(spark, sf_dir):
    rows = transcripts(spark, sf_dir, "read")
    part = lambda name: shown(F.transform("exons", lambda x: x[name]))
    return rows.select("ord", "gene_id", "tid", part("start").alias("starts"), part("end").alias("ends"))


@query
def transcript_extent(spark, sf_dir):
    rows = transcripts(spark, sf_dir, "read")
    return rows.select("ord", F.col("start").alias("t_start"), F.col("end").alias("t_end"), "is_rev", F.size("exons").alias("n_exons"))


@query
def interval_overlap_join(spark, sf_dir):
    reads, annotation = (kept(x, "spans") for x in _pair(spark, sf_dir))
    return classify.met(reads.select("ord", "tid", "start", "end"), annotation).select("ord", "rank")


def _classes(spark, sf_dir, params: Params) -> DataFrame:
    return classify.classified(*_pair(spark, sf_dir), params).select("ord", "class", "known", "has_known_site")


@query
def classify_compat(spark, sf_dir):
    return _classes(spark, sf_dir, Params())


@query
def classify_fixed(spark, sf_dir):
    return _classes(spark, sf_dir, Params(compat=False))


@query
def ref_gene_assign(spark, sf_dir):
    return classify.classified(*_pair(spark, sf_dir)).select("ord", F.coalesce("gene_id", F.lit("NA")).alias("gene_id"), "is_rev")


@query
def novel_exons(spark, sf_dir):
    return classify.classified(*_pair(spark, sf_dir)).select("ord", _bits(F.col("novel_exon")).alias("flags"))


@query
def novel_sites(spark, sf_dir):
    return classify.classified(*_pair(spark, sf_dir)).select("ord", _bits(F.col("novel_don")).alias("donors"), _bits(F.col("novel_acc")).alias("acceptors"))


@query
def novel_junctions(spark, sf_dir):
    return classify.classified(*_pair(spark, sf_dir)).select("ord", _bits(F.col("novel_junction")).alias("flags"))


@query
def full_length_levels(spark, sf_dir):
    return classify.classified(*_pair(spark, sf_dir)).select("ord", *(f"full_{k}" for k in classify.LEVELS))


@query
def single_exon_match(spark, sf_dir):
    reads, annotation = (kept(x.where("size(exons) = 1"), "spans") for x in _pair(spark, sf_dir))
    pairs = classify.met(reads.select("ord", "tid", "start", "end", "exons"), annotation)
    return classify.compared(pairs).select("ord", "rank", "is_known")


@query
def junction_support(spark, sf_dir):
    """Novel junctions of all reads, and whether short reads support them."""
    reads = classify.classified(*_pair(spark, sf_dir))
    novel = evidence.novel_joints(reads)
    missing = evidence.unsupported(novel, _sj(spark, sf_dir)).select("ord", "place", F.lit(True).alias("missing"))
    return novel.join(missing, ["ord", "place"], "left").select("ord", "place", "tid", "don", "acc", F.col("missing").isNull().alias("supported"))


@query
def read_support(spark, sf_dir):
    return _judged(spark, sf_dir).select("ord", "tested", "unreliable", _bits(F.col("unreliable_junction")).alias("flags"))


@query
def split_pieces(spark, sf_dir):
    reads = _judged(spark, sf_dir).where("full AND class = 'novel' AND unreliable")
    part = lambda name: shown(F.transform("exons", lambda x: x[name]))
    return split.pieces(reads).select("trans_id", "piece", F.col("start").alias("t_start"), F.col("end").alias("t_end"), part("start").alias("starts"), part("end").alias("ends"))


@query
def merge_identical_chain(spark, sf_dir):
    rows = merge.identical_chains(transcripts(spark, sf_dir, "read"), parts(spark, sf_dir))
    chain = lambda name: shown(F.transform("chain", lambda x: x[name]))
    return rows.select("tid", chain("don").alias("donors"), chain("acc").alias("acceptors"), "ord", F.col("start").alias("t_start"), F.col("end").alias("t_end"), "cov")


@query
def overlap_islands(spark, sf_dir):
    rows = intervals.islands(transcripts(spark, sf_dir, "read").select("tid", "start", "end", "ord"))
    return rows.groupBy("tid", "island").agg(F.count("*").alias("n"), F.max("end").alias("island_end"))


@query
def merge_greedy(spark, sf_dir):
    """The merge that depends on order."""
    rows = merge.merged(transcripts(spark, sf_dir, "read"))
    return rows.select("ord", "tid", F.col("start").alias("t_start"), F.col("end").alias("t_end"), "cov", "absorbed")


@query
def unique_shared(spark, sf_dir):
    """What the merge absorbed."""
    return merge.unique(transcripts(spark, sf_dir, "read"), absorbed=True).select("ord", "tid")


def _novel(spark, sf_dir) -> DataFrame:
    return update.accepted(_judged(spark, sf_dir))


@query
def novel_exon_bed(spark, sf_dir):
    rows = report.novel_exons(_novel(spark, sf_dir))
    return rows.select("tid", (F.col("start") - 1).alias("bed_start"), F.col("end").alias("bed_end"), "kind", "score", "is_rev")


@query
def novel_site_counts(spark, sf_dir):
    return report.novel_sites(_novel(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


@query
def novel_junction_counts(spark, sf_dir):
    return report.novel_junctions(_novel(spark, sf_dir))


@query
def class_summary(spark, sf_dir):
    return report.class_counts(_judged(spark, sf_dir))


@query
def detail_rows(spark, sf_dir):
    return report.detail(_judged(spark, sf_dir))


@query
def gene_run_count(spark, sf_dir):
    return report.gene_runs(transcripts(spark, sf_dir, "anno"))


@query
def gtf_sort_order(spark, sf_dir):
    """Sort keys of annotation lines."""
    rows = transcripts(spark, sf_dir, "anno").select("ord", F.concat(F.lit("chr"), F.col("tid") + 1).alias("seqname"), "start", "end", "exons")
    head = rows.select(F.lit("f").alias("file"), (F.col("ord") * 1000).alias("ord"), "seqname", F.lit("transcript").alias("feature"), "start", "end")
    body = rows.select("ord", "seqname", F.posexplode("exons").alias("place", "x"))
    body = body.select(F.lit("f").alias("file"), (F.col("ord") * 1000 + F.col("place") + 1).alias("ord"), "seqname", F.lit("exon").alias("feature"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    return gtf.sort_key(head.unionByName(body)).select("ord", "seqname", "feature", "chr_ord", "t_start", "t_end")


@query
def gtf_lines(spark, sf_dir):
    """Text lines of annotation transcripts."""
    rows = transcripts(spark, sf_dir, "anno").withColumn("seqname", F.concat(F.lit("chr"), F.col("tid") + 1)).withColumn("trans_id", F.col("ord").cast("string"))
    return gtf.lines(rows, "src").select("ord", "row", "value")


@query
def gtf_written(spark, sf_dir):
    """Annotation and novel transcripts, written as text and read back."""
    named = F.concat(F.lit("chr"), F.col("tid") + 1)
    annotation = transcripts(spark, sf_dir, "anno").withColumn("seqname", named).withColumn("gene_name", F.concat(F.lit("G"), "gene_id"))
    novel = classify.classified(transcripts(spark, sf_dir, "read"), annotation).where("class = 'novel'").withColumn("trans_id", F.concat(F.lit("r"), "ord"))
    path = new_path(spark, "gtf")
    gtf.write(update.with_novel(annotation, novel), path, "src")
    part = lambda name: shown(F.transform("exons", lambda x: x[name]))
    return gtf.read(spark, path).select("trans_id", "gene_id", "gene_name", "seqname", "is_rev", part("start").alias("starts"), part("end").alias("ends"))


def _records(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Alignments as records of a file, and their contigs."""
    rows = alignments(spark, sf_dir).withColumn("ord", F.col("qname") * 1000 + F.col("rec")).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    rows = rows.withColumn("qname", F.col("qname").cast("string")).withColumn("mapq", F.lit(60)).withColumn("as_score", F.lit(None).cast("int"))
    contigs = spark.range(25).select(F.concat(F.lit("chr"), F.col("id") + 1).alias("name"), F.col("id").alias("tid"), F.lit(10**8).alias("length"))
    return rows, contigs


@query
def bam_filtered(spark, sf_dir):
    """Alignments written as BAM, read back by ranges of blocks and filtered."""
    path = new_path(spark, "bam")
    rows, contigs = _records(spark, sf_dir)
    bam.write(rows, contigs, path)
    # By place in the files, records of a read aren't together.
    return select.filtered(bam.read(spark, path).drop("file"), STRICT).select("qname", "tid", "pos", "score", "n_introns")


@query
def sam_filtered(spark, sf_dir):
    """Alignments written as SAM with a header, gzipped, read back and filtered."""
    path = new_path(spark, "sam")
    rows, contigs = _records(spark, sf_dir)
    sam.write(rows, contigs, path, compression="gzip")
    return select.filtered(sam.read(spark, path), STRICT).select("qname", "tid", "pos", "score", "second", "n_introns")


@query
def best_of_runs(spark, sf_dir):
    """The best record of each run of records of a read, in a file where every
    read comes twice: in one half of the file and the other."""
    rows = alignments(spark, sf_dir).withColumn("ord", F.pmod("rec", F.lit(2)) * 10**10 + F.col("qname") * 100 + F.col("rec"))
    rows = select.alike_enough(select.covered_enough(select.measured(rows), STRICT), STRICT)
    # Runs look at the rows twice.
    rows = select.runs(kept(rows.select("qname", "ord", "score", "n_introns"), "judged"))
    return select.best(rows, STRICT, "run").select("qname", "run", "ord", "score", "second")


#: Bases of a line of the made genome, and what base is where.
WIDTH, BASES = 60, "GTAGCTACATATGCAGC"
#: Lines of it in a row whose numbers are made together.
LINES = 1 << 12


@query
def genome_motifs(spark, sf_dir):
    """Junctions with motifs and strands from a genome that is written as FASTA.

    The genome's bases follow from their places; its contigs end beyond the
    last alignment.
    """
    rows = alignments(spark, sf_dir).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    n = F.floor((F.max("pos") + 1000) / WIDTH).cast("int")
    # A task writes contigs line by line, in order, and holds none.
    spans = rows.groupBy("tid").agg(n.alias("n")).repartition(25, "tid")
    blocks = spans.select("tid", "n", F.explode(F.sequence(F.lit(-1), F.floor(F.col("n") / LINES).cast("int"))).alias("block"))
    first = F.col("block") * LINES
    contigs = blocks.select("tid", F.explode(F.when(F.col("block") < 0, F.array(F.lit(-1))).otherwise(F.sequence(first, F.least(first + LINES - 1, F.col("n"))))).alias("k"))
    place = lambda i: F.col("k").cast("long") * WIDTH + i
    base = lambda i: F.substr(F.lit(BASES), ((place(i) * place(i) + 3 * place(i) + F.col("tid")) % len(BASES) + 1).cast("int"), F.lit(1))
    bases = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(WIDTH)), base), "")
    contigs = contigs.select("tid", "k", bases.alias("bases"))
    line = F.when(F.col("k") < 0, F.concat(F.lit(">chr"), F.col("tid") + 1, F.lit(" made"))).when(F.col("k") % 3 == 0, F.lower("bases")).otherwise(F.col("bases"))
    path = new_path(spark, "genome")
    contigs.select(line.alias("value")).write.text(path)
    found = junctions.extracted(rows, genome=tables.genome(spark, path))
    return junctions.counted(found).select("tid", "don", "acc", "strand", "motif", "uniq_c", "multi_c")


@query
def exon_parts(spark, sf_dir):
    """The union of all exons, cut at their splice sites."""
    cut = merge.exon_parts(transcripts(spark, sf_dir, "read").unionByName(transcripts(spark, sf_dir, "anno")))
    return cut.select("tid", F.col("start").alias("p_start"), F.col("end").alias("p_end"))


@query
def gene_gtf(spark, sf_dir):
    """Annotation genes as text."""
    rows = transcripts(spark, sf_dir, "anno").withColumn("seqname", F.concat(F.lit("chr"), F.col("tid") + 1)).withColumn("trans_id", F.col("ord").cast("string"))
    return gtf.gene_text(rows.withColumn("gene_name", F.concat(F.lit("G"), "gene_id")), "src")


@query
def junction_file(spark, sf_dir):
    """Counted junctions as a table of nine columns, written, and read with the
    numbers of contigs of which one is unknown."""
    rows = alignments(spark, sf_dir).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    counts = junctions.counted(junctions.extracted(rows)).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    path = new_path(spark, "junction-table")
    tables.junctions_from_counts(counts).write.csv(path, sep="\t")
    contigs = spark.range(24).select(F.concat(F.lit("chr"), F.col("id") + 1).alias("name"), F.col("id").cast("int").alias("tid"))
    return tables.read_junctions(spark, path, contigs).select("chrom", "tid", "don", "acc", "uniq_c", "multi_c")


@query
def junction_order(spark, sf_dir):
    """A junction file as it is written: its lines and their order."""
    rows = alignments(spark, sf_dir).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    counts = junctions.counted(junctions.extracted(rows)).withColumn("chrom", F.concat(F.lit("chr"), F.col("tid") + 1))
    path = new_path(spark, "junctions")
    tables.write_junctions(counts, path)
    lines = ordered.run_heads(gtf.numbered(spark, path).drop("file"), F.col("ord"), "head", "place")
    return lines.select("place", "value")


@query
def gtf_odd(spark, sf_dir):
    """Annotation lines of which some lack an id or a name, on contigs of which
    one is unknown, written with ids only and read back."""
    rows = transcripts(spark, sf_dir, "anno").withColumn("seqname", F.concat(F.lit("chr"), F.col("tid") + 1)).withColumn("trans_id", F.concat(F.lit("t"), "ord"))
    short = gtf.lines(rows, "src", full=False).where("value LIKE '%\texon\t%'")
    # By number: a gene's name for its id, a transcript's name for its id.
    named = F.when(F.col("ord") % 30 == 0, F.regexp_replace("value", "gene_id", "gene_name")).when(F.col("ord") % 30 == 10, F.regexp_replace("value", "transcript_id", "transcript_name")).otherwise(F.col("value"))
    path = new_path(spark, "odd-gtf")
    gtf.write_lines(short.select("ord", "row", named.alias("value")), ["ord"], path)
    contigs = spark.range(24).select(F.concat(F.lit("chr"), F.col("id") + 1).alias("name"), F.col("id").cast("int").alias("tid"))
    out = gtf.read(spark, path, contigs)
    return out.select("trans_id", "trans_name", "gene_id", "gene_name", "tid", F.size("exons").alias("n_exons"), "is_rev")


#: A contig and two places on it.
REGION = (3, 5000, 9000)


@query
def region_read(spark, sf_dir):
    """Records of a region, from alignments that are written by place with an index."""
    path = new_path(spark, "placed")
    placed.write(alignments(spark, sf_dir).withColumn("ord", F.col("qname") * 1000 + F.col("rec")), path, max(16, parts(spark, sf_dir)))
    return placed.region(spark, path, *REGION).select("qname", "rec", "pos", F.col("end").alias("last"))


@query
def full_gate(spark, sf_dir):
    """Novel transcripts that are accepted at each full-length level."""
    reads = classify.classified(*_pair(spark, sf_dir)).where("class = 'novel'")
    levels = F.array(*(F.when(F.col(f"full_{k}"), F.lit(k)) for k in (1, 2, 3, 4)))
    return reads.select(F.explode(levels).alias("level"), "ord").where("level IS NOT NULL")


@query
def distance_support(spark, sf_dir):
    """Novel junctions without a short-read junction within two, and fifty, bases."""
    novel = kept(evidence.novel_joints(classify.classified(*_pair(spark, sf_dir))), "joints")
    far = [evidence.unsupported(novel, _sj(spark, sf_dir), Params(site_distance=d)).select("ord", "place", F.lit(d).alias("distance")) for d in (2, 50)]
    return far[0].unionByName(far[1])


@query
def union_annotation(spark, sf_dir):
    novel = _judged(spark, sf_dir).where("class = 'novel'")
    rows = update.with_novel(transcripts(spark, sf_dir, "anno"), novel)
    return rows.select("ord", "trans_id", "tid", F.size("exons").alias("n_exons"), "is_new")


@query
def exon_union(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_exon").select("tid", F.col("es").alias("start"), F.col("ee").alias("end"), F.col("ok").alias("ord"))
    return intervals.union(rows).select("tid", F.col("start").alias("u_start"), F.col("end").alias("u_end"), "n")


@query
def gene_extent(spark, sf_dir):
    rows = gtf.gene_lines(transcripts(spark, sf_dir, "anno"))
    return rows.select("gene_id", "tid", F.col("start").alias("g_start"), F.col("end").alias("g_end"), "n_transcripts")


@query
def intron_motif(spark, sf_dir):
    """Motif number of introns of a made sequence."""
    ends = F.array(*map(F.lit, ["gtAG", "CTac", "GCAG", "ctgc", "ATAC", "GTAT", "GTAC", "NNAG"]))
    made = F.element_at(ends, ((F.col("don") + F.col("acc")) % 8 + 1).cast("int"))
    rows = view(spark, sf_dir, "fx_sj").select("tid", "don", "acc", F.concat(F.substring(made, 1, 2), F.repeat(F.lit("A"), (F.col("don") % 3).cast("int")), F.substring(made, 3, 2)).alias("s"))
    return rows.select("tid", "don", "acc", junctions.motif(F.col("s"), F.lit(1), F.length("s")).alias("motif"))


def _segments(spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir, "fx_seg").withColumn("ord", F.col("rec").cast("long")).withColumn("is_rev", F.col("is_rev") == 1)


@query
def fusion_segments(spark, sf_dir):
    rows = alignments(spark, sf_dir).withColumn("as_score", F.lit(None).cast("int"))
    return fusion.segments(rows)


@query
def fusion_pairs(spark, sf_dir):
    """Reads of two parts, ranked, and whether the parts go together."""
    rows = fusion.ranked(_segments(spark, sf_dir)).where("size(parts) = 2")
    a, b = F.col("parts")[0], F.col("parts")[1]
    apart = lambda compat: fusion.overlap_ratio(a, b, "read_start", "read_end", compat) <= F.lit(0.1).cast("float")
    return rows.select("qname", a["ord"].alias("first_ord"), apart(True).alias("apart"), apart(False).alias("apart_fixed"), fusion.compatible(a, b).alias("fits"))


@query
def fusion_greedy(spark, sf_dir):
    """Reads whose parts, taken greedily, make a fusion of two."""
    return fusion.fusions(_segments(spark, sf_dir)).drop("ords")


@query
def update_summary(spark, sf_dir):
    """The whole update of the annotation, as its summary."""
    reads, annotation = _pair(spark, sf_dir)
    params = Params(split=True)
    rows = update.judged(reads, annotation, _sj(spark, sf_dir), params).withColumn("trans_id", F.col("ord").cast("string"))
    rows, annotation = kept(rows, "reads"), kept(annotation, "annotation")
    new = kept(update.updated(update.accepted(rows, params), params), "updated")
    return report.summary(rows, annotation, new, params)
