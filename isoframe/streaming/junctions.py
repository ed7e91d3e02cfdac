"""Junction counts of alignments that keep arriving.

Counting is a plain sum, so the batch operator's extraction runs on a stream
unchanged and the counts are kept as streaming state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from isoframe.operators.junctions import extracted
from isoframe.params import Params


def counts(alignments: DataFrame, params: Params = Params()) -> DataFrame:
    """tid, don, acc, strand, uniq_c, multi_c over a stream of alignments."""
    rows = extracted(alignments, params)
    strand = F.when(F.min("strand") == F.max("strand"), F.min("strand")).otherwise(0)
    return rows.groupBy("tid", "don", "acc").agg(strand.alias("strand"), F.sum(F.col("is_uniq").cast("long")).alias("uniq_c"), F.sum((~F.col("is_uniq")).cast("long")).alias("multi_c"))


def start(alignments: DataFrame, name: str, checkpoint: str, params: Params = Params()) -> StreamingQuery:
    """Keep the counts in a table in memory, all of them after each batch."""
    return counts(alignments, params).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).start()


def save(alignments: DataFrame, path: str, checkpoint: str, params: Params = Params()) -> StreamingQuery:
    """Keep the counts in a folder of tables, of each batch what it changed.

    Counts are streaming state; a batch writes the new totals of its junctions to a folder
    of its own number.  A batch that runs again after a restart replaces
    what it wrote, so nothing is counted twice; ``totals`` reads the latest.
    """

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return counts(alignments, params).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).start()


def totals(spark: SparkSession, path: str) -> DataFrame:
    """tid, don, acc, strand, uniq_c, multi_c as of the last batch."""
    rows = spark.read.parquet(path)
    latest = F.max_by(F.struct("strand", "uniq_c", "multi_c"), "batch").alias("x")
    return rows.groupBy("tid", "don", "acc").agg(latest).select("tid", "don", "acc", "x.*")


def compact(spark: SparkSession, path: str, into: str) -> None:
    """Write the totals so far as one batch, numbered as the last, to another folder."""
    last = spark.read.parquet(path).agg(F.max("batch")).head()[0]
    totals(spark, path).write.mode("overwrite").parquet(f"{into}/batch={last}")
