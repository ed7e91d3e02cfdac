"""Reads whose alignments join two distant places: candidate gene fusions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.functions import cigar
from isoframe.params import Params

SEGMENT = "struct<score:int,ed:int,ord:bigint,tid:int,is_rev:boolean,read_start:int,read_end:int,ref_start:int,ref_end:int>"
FIELDS = ["score", "ed", "ord", "tid", "is_rev", "read_start", "read_end", "ref_start", "ref_end"]


def size(text: str) -> int:
    """A number with an optional k, M or G at its end, halves rounded up."""
    scale = {"k": 10**3, "m": 10**6, "g": 10**9}.get(text[-1:].lower())
    return int(float(text[:-1]) * scale + 0.5) if scale else int(text)


def segments(alignments: DataFrame) -> DataFrame:
    """Read and reference intervals of mapped alignments.

    Read places count along the read as it was sequenced.  A missing score or
    edit distance is 0.
    """
    rows = alignments.where(F.col("flag").bitwiseAND(4) == 0).withColumn("ops", cigar.ops(F.col("cigar")))
    ops = F.col("ops")
    head = F.coalesce(F.when(F.get(ops, F.lit(0))["op"].isin("S", "H"), F.get(ops, F.lit(0))["len"]), F.lit(0))
    rows = rows.withColumn("rlen", cigar.query_length(ops)).withColumn("is_rev", F.col("flag").bitwiseAND(16) != 0)
    rows = rows.withColumn("a", head + 1).withColumn("b", head + cigar.length(ops, "MI=X"))
    turned = lambda x, y: F.when(F.col("is_rev"), F.col("rlen") + 1 - F.col(y)).otherwise(F.col(x))
    return rows.select(
        "qname", "ord", F.coalesce("as_score", F.lit(0)).alias("score"), F.coalesce("nm", F.lit(0)).alias("ed"), "tid", "is_rev", "rlen",
        turned("a", "b").alias("read_start"), turned("b", "a").alias("read_end"),
        (F.col("pos") + 1).alias("ref_start"), (F.col("pos") + cigar.reference_length(ops)).alias("ref_end"),
    )


def overlap_ratio(a: Column, b: Column, start: str, end: str, compat: bool = True) -> Column:
    """Overlap of two parts by the shorter one.

    In compat mode the overlap runs from the start of b to the end of a, which
    depends on their order and can exceed 1.
    """
    apart = (a[start] > b[end]) | (b[start] > a[end])
    shared = a[end] - b[start] + 1
    if not compat:
        shared = F.least(a[end], b[end]) - F.greatest(a[start], b[start]) + 1
    return F.when(apart, F.lit(0.0)).otherwise(shared / (F.least(a[end] - a[start], b[end] - b[start]) + 1)).cast("float")


def compatible(a: Column, b: Column, params: Params = Params()) -> Column:
    """Whether chosen part a and candidate b can be parts of one fusion."""
    reads = overlap_ratio(a, b, "read_start", "read_end", params.compat) <= F.lit(params.part_overlap).cast("float")
    gap = F.greatest(a["ref_start"] - b["ref_end"], b["ref_start"] - a["ref_end"])
    overlaps = ~((a["ref_start"] > b["ref_end"]) | (b["ref_start"] > a["ref_end"]))
    near = (a["tid"] == b["tid"]) & (overlaps | ((gap > 0) & (gap < params.part_distance)))
    return reads & ~near


def union_length(parts: Column) -> Column:
    """Read bases that some part covers."""
    step = lambda at, x: F.struct(
        (at["n"] + F.greatest(F.lit(0), x["read_end"] - F.greatest(x["read_start"] - 1, at["far"]))).alias("n"), F.greatest(at["far"], x["read_end"]).alias("far"),
    )
    ordered = F.array_sort(F.transform(parts, lambda x: F.struct(x["read_start"], x["read_end"])))
    return F.aggregate(ordered, F.struct(F.lit(0).alias("n"), F.lit(0).alias("far")), step, lambda at: at["n"])


def ranked(parts: DataFrame) -> DataFrame:
    """One row a read: its parts by score, edits and place, and its length."""
    key = F.struct((-F.col("score")).alias("k"), "ed", "ord", F.struct(*FIELDS).cast(SEGMENT).alias("s"))
    rows = parts.groupBy("qname").agg(F.array_sort(F.collect_list(key)).alias("parts"), F.min_by("rlen", "ord").alias("rlen"))
    return rows.withColumn("parts", F.transform("parts", lambda x: x["s"]))


def chosen(parts: DataFrame, params: Params = Params()) -> DataFrame:
    """qname, parts, done: the parts taken in rank order, and if they suffice.

    The first is always taken; others must cover enough of the read and go with
    all taken; it ends once the parts together cover enough of it.
    """
    start = F.struct(F.slice("parts", 1, 1).alias("taken"), F.lit(False).alias("done"))
    share = lambda n: n / F.col("rlen")

    def step(at: Column, x: Column) -> Column:
        large = share(x["read_end"] - x["read_start"] + 1) >= F.lit(params.part_coverage).cast("float")
        fits = ~at["done"] & large & F.forall(at["taken"], lambda a: compatible(a, x, params))
        taken = F.when(fits, F.concat(at["taken"], F.array(x))).otherwise(at["taken"])
        full = share(union_length(taken)).cast("float") >= F.lit(params.total_coverage).cast("float")
        return F.struct(taken.alias("taken"), (at["done"] | (fits & full)).alias("done"))

    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    return ranked(parts).select("qname", F.aggregate(rest, start, step).alias("c")).select("qname", F.col("c.taken").alias("parts"), F.col("c.done").alias("done"))


def fusions(parts: DataFrame, params: Params = Params()) -> DataFrame:
    """Reads of exactly two parts: both, the one that comes first in the read left."""
    rows = chosen(parts, params).where("done AND size(parts) = 2")
    one, two = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))
    swapped = one["read_start"] >= two["read_start"]
    rows = rows.withColumn("l", F.when(swapped, two).otherwise(one)).withColumn("r", F.when(swapped, one).otherwise(two))
    side = lambda s, name: [F.col(f"{s}.{c}").alias(f"{name}_{c}") for c in ("tid", "is_rev", "ref_start", "ref_end")]
    return rows.select("qname", *side("l", "left"), *side("r", "right"), F.transform("parts", lambda x: x["ord"]).alias("ords"))


def records(alignments: DataFrame, found: DataFrame) -> DataFrame:
    """The alignments that make the parts of fusions."""
    return alignments.join(found.select(F.explode("ords").alias("ord")), "ord", "left_semi")
