"""CIGAR strings as columns: operations, lengths, exons and introns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PATTERN = "([0-9]+)([MIDNSHPX=B])"
SPANS = "array<struct<start:int,end:int>>"


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with more columns, each worked out once a row.

    Conditions on a plain column are moved before it, and the column is worked out
    again in each; they aren't moved before an array that is unpacked.
    """
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


def ops(cigar: Column) -> Column:
    """array<struct<len int, op string>>, null for a null string."""
    part = lambda i: F.regexp_extract_all(cigar, F.lit(PATTERN), F.lit(i))
    return F.zip_with(part(1), part(2), lambda n, op: F.struct(n.cast("int").alias("len"), op.alias("op")))


def length(operations: Column, kinds: str) -> Column:
    """Bases of the operations of some kinds."""
    return F.aggregate(operations, F.lit(0), lambda n, x: n + F.when(F.instr(F.lit(kinds), x["op"]) > 0, x["len"]).otherwise(0))


def query_length(operations: Column) -> Column:
    """Bases of the read, with those clipped off, soft or hard."""
    return length(operations, "MISH=X")


def reference_length(operations: Column) -> Column:
    return length(operations, "MDN=X")


def count(operations: Column, kind: str, least: int = 0) -> Column:
    """Operations of a kind that are at least so long."""
    return F.size(F.filter(operations, lambda x: (x["op"] == kind) & (x["len"] >= least)))


def end_clips(operations: Column) -> Column:
    """Bases clipped at both ends; one operation alone counts once."""
    clip = lambda x: F.when(x["op"].isin("S", "H"), x["len"]).otherwise(0)
    first, last = F.try_element_at(operations, F.lit(1)), F.try_element_at(operations, F.lit(-1))
    return clip(first) + F.when(F.size(operations) > 1, clip(last)).otherwise(0)


def exons(operations: Column, start: Column, min_exon: int, min_intron: int, max_deletion: int) -> Column:
    """Exons from a first base on, as an array of inclusive spans.

    Skips of ``min_intron`` and deletions of more than ``max_deletion`` end an
    exon; an ended one stays if it is the first or has ``min_exon`` bases.
    """
    open_ = F.struct(start.cast("int").alias("start"), (start - 1).cast("int").alias("end"), F.array().cast(SPANS).alias("done"))

    def step(at: Column, x: Column) -> Column:
        closes = ((x["op"] == "N") & (x["len"] >= min_intron)) | ((x["op"] == "D") & (x["len"] > max_deletion))
        moved = at["end"] + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["len"]).otherwise(0)
        long = (F.size(at["done"]) == 0) | (at["end"] - at["start"] + 1 >= min_exon)
        done = F.when(closes & long, F.concat(at["done"], F.array(F.struct(at["start"], at["end"])))).otherwise(at["done"])
        return F.struct(F.when(closes, moved + 1).otherwise(at["start"]).alias("start"), moved.alias("end"), done.cast(SPANS).alias("done"))

    return F.aggregate(operations, open_, step, lambda at: F.concat(at["done"], F.array(F.struct(at["start"], at["end"]))).cast(SPANS))


def introns(operations: Column, start: Column, min_intron: int) -> Column:
    """Skipped spans of ``min_intron`` bases or more."""
    open_ = F.struct((start - 1).cast("int").alias("end"), F.array().cast(SPANS).alias("done"))

    def step(at: Column, x: Column) -> Column:
        moved = at["end"] + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["len"]).otherwise(0)
        here = (x["op"] == "N") & (x["len"] >= min_intron)
        done = F.when(here, F.concat(at["done"], F.array(F.struct((at["end"] + 1).alias("start"), moved.alias("end"))))).otherwise(at["done"])
        return F.struct(moved.alias("end"), done.cast(SPANS).alias("done"))

    return F.aggregate(operations, open_, step, lambda at: at["done"])
