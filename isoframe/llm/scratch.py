"""Written tables that cut lineage; see ``isoframe.plans.cut``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isoframe.plans.cut import discard, kept, kept_tidily, new_path

__all__ = ["discard", "kept_tidily", "new_path", "short_batches", "written"]

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows of whole texts that go to a Python worker at once, at most: batches of Spark's
#: default size would hold some tens of MB in the worker and again in the executor.
BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> str:
    """Let this session's batches have BATCH_ROWS rows at most; gives the number before."""
    before = spark.conf.get(BATCH, "10000")
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    return before


def written(df: DataFrame, name: str) -> DataFrame:
    """``kept``, with short batches for the Python workers of the write."""
    before = short_batches(df.sparkSession)
    try:
        return kept(df, name)
    finally:
        df.sparkSession.conf.set(BATCH, before)
