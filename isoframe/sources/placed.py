"""Alignments by place, with an index of the files that a region needs.

Files follow one another by contig and position.  The index has a row for each
window of a contig and file with a record that touches it, so that a region is read from
the files it needs and no others, records that reach into it from before included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.functions import cigar

#: Bases of a window of the index.
WINDOW = 1 << 14


def write(records: DataFrame, path: str, files: int | None = None) -> None:
    """Write mapped records in order of contig, position and ord, and their index.

    Each gets ``end``, the last base that it covers, as ``pos`` counted from 0.
    Unmapped records, which have no place, are written beside them.
    """
    mapped = (F.col("flag").bitwiseAND(4) == 0) & (F.col("tid") >= 0)
    order = ["tid", "pos", "ord"]
    dealt = records.where(mapped).repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order)
    # After the shuffle, whose keys are sampled in a run of their own.
    placed = dealt.withColumn("end", F.col("pos") + F.greatest(cigar.reference_length(cigar.ops(F.col("cigar"))), F.lit(1)) - 1)
    placed.write.parquet(f"{path}/records")
    records.where(~F.coalesce(mapped, F.lit(False))).write.parquet(f"{path}/unplaced")
    spark = records.sparkSession
    rows = spark.read.parquet(f"{path}/records").select("tid", "pos", "end", F.input_file_name().alias("file"))
    windows = F.sequence(F.floor(F.col("pos") / WINDOW), F.floor(F.col("end") / WINDOW))
    index = rows.select("tid", F.explode(windows).alias("window"), "file").distinct()
    index.repartitionByRange("tid", "window").sortWithinPartitions("tid", "window").write.parquet(f"{path}/index")


def files(spark: SparkSession, path: str, tid: int, start: int, end: int) -> list[str]:
    """Files with a record that touches a window of the region, by name."""
    index = spark.read.parquet(f"{path}/index")
    windows = F.col("window").between(start // WINDOW, end // WINDOW)
    # No more than there are files.
    return sorted(r["file"] for r in index.where((F.col("tid") == tid) & windows).select("file").distinct().collect())


def region(spark: SparkSession, path: str, tid: int, start: int, end: int) -> DataFrame:
    """Records that cover a base of ``start`` to ``end``, counted from 0."""
    needed = files(spark, path, tid, start, end)
    plain = spark.read.parquet(f"{path}/records")
    rows = spark.read.schema(plain.schema).parquet(*needed) if needed else plain.limit(0)
    return rows.where((F.col("tid") == tid) & (F.col("pos") <= end) & (F.col("end") >= start))
