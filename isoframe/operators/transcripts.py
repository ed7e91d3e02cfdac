"""Transcripts as rows with nested exons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.functions import cigar
from isoframe.params import Params


def strand(xs: Column, flag: Column) -> Column:
    """Whether a read lies on the reverse strand: its XS tag, or else its flag."""
    return F.coalesce(xs != "+", flag.bitwiseAND(16) != 0)


def from_alignments(alignments: DataFrame, params: Params = Params()) -> DataFrame:
    """One transcript for each mapped alignment, named by its read."""
    mapped = alignments.where(F.col("flag").bitwiseAND(4) == 0)
    spans = cigar.exons(cigar.ops(F.col("cigar")), F.col("pos") + 1, params.min_exon, params.min_intron, params.max_deletion)
    rows = cigar.once(mapped, exons=spans).withColumn("is_rev", strand(F.col("xs"), F.col("flag")))
    names = [F.col("chrom").alias("seqname")] if "chrom" in rows.columns else []
    return extent(rows.select("ord", F.col("qname").cast("string").alias("trans_id"), "tid", *names, "is_rev", "exons"))


def extent(transcripts: DataFrame) -> DataFrame:
    """Start and end from the first and the last exon; coverage 1."""
    out = transcripts.withColumn("start", F.try_element_at("exons", F.lit(1))["start"]).withColumn("end", F.try_element_at("exons", F.lit(-1))["end"])
    return out if "cov" in out.columns else out.withColumn("cov", F.lit(1))


def nested(exons: DataFrame) -> DataFrame:
    """Transcripts of exon rows: ord, gene_id, tid, is_rev, start, end, exons, cov."""
    span = F.struct("start", "end")
    rows = exons.groupBy("ord").agg(
        F.min("gene_id").alias("gene_id"), F.min("tid").alias("tid"), F.max("is_rev").alias("is_rev"), F.array_sort(F.collect_list(span)).alias("exons"),
    )
    return extent(rows)


def ends(exons: Column) -> Column:
    """Last bases of all exons but the last: donor sites."""
    return F.transform(F.slice(exons, 1, F.size(exons) - 1), lambda x: x["end"])


def starts(exons: Column, first: bool = False) -> Column:
    """First bases of all exons but the first, or but the last."""
    part = F.slice(exons, 1, F.size(exons) - 1) if first else F.slice(exons, 2, F.greatest(F.size(exons) - 1, F.lit(0)))
    return F.transform(part, lambda x: x["start"])


def joints(exons: Column) -> Column:
    """Pairs of a donor and an acceptor site."""
    return F.zip_with(ends(exons), starts(exons), lambda a, b: F.struct(a.alias("don"), b.alias("acc")))


def shown(values: Column) -> Column:
    """An array as comma-joined text."""
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",")
