"""Splice junctions of short-read alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.functions import cigar
from isoframe.params import Params
from isoframe.plans.cut import kept
from isoframe.sources.tables import CHUNK

#: The splice motifs, numbered from 1; odd ones lie on the
#: forward strand, 1, and even ones on the reverse strand, 2.
MOTIFS = ["GTAG", "CTAC", "GCAG", "CTGC", "ATAC", "GTAT"]

#: Reads of an intron from which they are dealt over parts.
CROWD = 50_000


def number(bases: Column) -> Column:
    """Number of the motif of four bases, 0 if it is none."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, MOTIFS)), F.upper(bases)), F.lit(0)).cast("int")


def motif(sequence: Column, don: Column, acc: Column) -> Column:
    """Number of the motif at both ends of an intron of a sequence, 0 if it is none."""
    return number(F.concat(F.substring(sequence, don, F.lit(2)), F.substring(sequence, acc - 1, F.lit(2))))


def motifs(introns: DataFrame, genome: DataFrame) -> DataFrame:
    """chrom, don, acc, motif of distinct introns, by the bases at their ends.

    ``genome`` (chrom, chunk, bases) is that of ``sources.tables.genome``: each
    end is looked up in the chunk that it lies in.  Whole sequences (chrom,
    sequence) are cut into chunks first.
    """
    if "sequence" in genome.columns:
        chunk = F.explode(F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / CHUNK).cast("int")))
        genome = genome.select("chrom", "sequence", chunk.alias("chunk")).select("chrom", "chunk", F.substr("sequence", F.col("chunk") * CHUNK + 1, F.lit(CHUNK + 1)).alias("bases"))
    distinct = introns.select("chrom", "don", "acc").distinct()
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("don").alias("at")), F.struct(F.lit(1).alias("side"), (F.col("acc") - 1).alias("at"))))
    ends = distinct.select("chrom", "don", "acc", sides.alias("x")).select("chrom", "don", "acc", "x.side", (F.col("x.at") - 1).alias("at"))
    found = ends.withColumn("chunk", F.floor(F.col("at") / CHUNK)).join(genome, ["chrom", "chunk"])
    two = F.substr("bases", (F.col("at") - F.col("chunk") * CHUNK + 1).cast("int"), F.lit(2))
    of = lambda side: F.max(F.when(F.col("side") == side, two))
    bases = found.groupBy("chrom", "don", "acc").agg(of(0).alias("left"), of(1).alias("right"))
    return bases.select("chrom", "don", "acc", number(F.concat("left", "right")).alias("motif"))


def extracted(alignments: DataFrame, params: Params = Params(), genome: DataFrame | None = None, paired: bool = True) -> DataFrame:
    """A row for each intron of a mapped, properly paired alignment.

    ``genome`` (see ``motifs``; joined by name) gives motifs and strands; it
    and ``alignments`` then need a column chrom.
    """
    mapped = alignments.where(F.col("flag").bitwiseAND(4) == 0)
    if paired:
        mapped = mapped.where(F.col("flag").bitwiseAND(2) != 0)
    spans = cigar.introns(cigar.ops(F.col("cigar")), F.col("pos") + 1, params.min_intron)
    names = ["tid"] if genome is None else ["tid", "chrom"]
    rows = mapped.select("ord", *names, F.coalesce(F.col("nh") == 1, F.lit(False)).alias("is_uniq"), F.posexplode(spans).alias("place", "span"))
    rows = rows.select("ord", *names, "is_uniq", "place", F.col("span.start").alias("don"), F.col("span.end").alias("acc"))
    if genome is None:
        return rows.withColumn("motif", F.lit(0)).withColumn("strand", F.lit(0))
    keys = ["chrom", "don", "acc"]
    counts = kept(rows.groupBy(*keys).agg(F.count("*").alias("n")), "introns")
    # Introns that many reads have are dealt over parts; no more rows than reads by CROWD.
    common = F.broadcast(counts.where(F.col("n") > CROWD).select(*keys, F.ceil(F.col("n") / CROWD).cast("int").alias("parts")))
    n = F.coalesce("parts", F.lit(1))
    parts = motifs(counts, genome).join(common, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).drop("parts")
    dealt = rows.join(common, keys, "left").withColumn("part", F.pmod(F.xxhash64("ord", "place"), n).cast("int")).drop("parts")
    found = dealt.join(parts, [*keys, "part"], "left").drop("part").withColumn("motif", F.coalesce("motif", F.lit(0)))
    return found.withColumn("strand", F.when(F.col("motif") == 0, 0).otherwise(2 - F.col("motif") % 2))


def counted(junctions: DataFrame) -> DataFrame:
    """Unique and other reads of each junction; strand 0 where they differ."""
    same = F.when(F.min("strand") == F.max("strand"), F.min("strand")).otherwise(0)
    return junctions.groupBy("tid", "don", "acc").agg(
        same.alias("strand"), F.min_by("motif", F.struct("ord", "place")).alias("motif"), F.lit(1).alias("is_anno"),
        F.sum(F.col("is_uniq").cast("long")).alias("uniq_c"), F.sum((~F.col("is_uniq")).cast("long")).alias("multi_c"),
    )
