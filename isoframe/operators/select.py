"""Choice of one confident alignment for each read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoframe.functions import cigar, intervals
from isoframe.functions.ordered import run_heads
from isoframe.params import Params
from isoframe.plans.cut import kept


def measured(alignments: DataFrame) -> DataFrame:
    """Mapped alignments with their covered bases, introns, deletions, score.

    Rows without an edit distance are left out: they can't be judged.
    """
    rows = alignments.where((F.col("flag").bitwiseAND(4) == 0) & F.col("nm").isNotNull())
    rows = cigar.once(rows, ops=cigar.ops(F.col("cigar"))).where(F.size("ops") > 0)
    rows = cigar.once(
        rows, covered=F.col("l_qseq") - cigar.end_clips(F.col("ops")), n_introns=cigar.count(F.col("ops"), "N"),
        deleted=cigar.length(F.col("ops"), "D"), ref_len=cigar.length(F.col("ops"), "MDN=X"),
    )
    return rows.withColumn("score", F.col("covered") - F.col("nm") + F.col("deleted")).drop("ops")


def covered_enough(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """Alignments that cover enough of their read.

    A read without stored bases has no ratio: it passes if nothing is clipped.
    """
    ratio = F.try_divide(F.col("covered").cast("double"), F.col("l_qseq"))
    least = F.lit(params.min_coverage).cast("float").cast("double")
    return rows.where(F.when(F.col("l_qseq") == 0, F.col("covered") == 0).otherwise(ratio >= least))


def alike_enough(rows: DataFrame, params: Params = Params()) -> DataFrame:
    """Alignments with few enough edits, in 32-bit arithmetic."""
    least = F.lit(params.min_identity).cast("float") * F.col("covered").cast("float")
    return rows.where(F.col("score").cast("float") >= least)


def outside(rows: DataFrame, removal: DataFrame) -> DataFrame:
    """Alignments that touch no transcript of ``removal`` (tid, start, end).

    With the tool's coordinates a record at ``pos`` covers pos..pos+ref_len-1.
    """
    # Read twice: for the spans that are joined, and for what they leave.
    spans = kept(rows, "judged").select("*", F.col("pos").alias("start"), (F.col("pos") + F.col("ref_len") - 1).alias("end"))
    # The overlap join asks for more than a shared end, so ends are widened.
    other = removal.select("tid", (F.col("start") - 1).alias("start"), (F.col("end") + 1).alias("end"))
    return intervals.overlap_join(spans, other, ["tid"], "left_anti", ["qname", "ord"]).drop("start", "end")


def runs(rows: DataFrame) -> DataFrame:
    """``rows`` with ``run``: a new one where the read name changes, by file and ord.

    Runs are numbered from 1 in each file.
    """
    return run_heads(rows, F.col("qname"), "first_ord", "run").drop("first_ord")


def best(rows: DataFrame, params: Params = Params(), group: str = "qname") -> DataFrame:
    """The best record of each read, if the second best is clearly worse.

    The first of equal scores is the best; then the second is as good, and the
    read is left out unless the ratio allows it.  Reads of different files are
    different reads.
    """
    order = Window.partitionBy(*(c for c in ("file", group) if c in rows.columns)).orderBy(F.col("score").desc(), "ord")
    ranked = rows.withColumn("place", F.row_number().over(order)).withColumn("second", F.coalesce(F.lead("score").over(order), F.lit(0)))
    second = F.greatest("second", F.lit(0)).cast("float") < F.lit(params.max_second).cast("float") * F.col("score").cast("float")
    return ranked.where((F.col("place") == 1) & second & (F.col("n_introns") >= params.min_introns)).drop("place")


def filtered(alignments: DataFrame, params: Params = Params(), removal: DataFrame | None = None, group: str = "qname") -> DataFrame:
    """All steps: coverage, identity, removal and the best record of each read."""
    rows = alike_enough(covered_enough(measured(alignments), params), params)
    return best(rows if removal is None else outside(rows, removal), params, group)
