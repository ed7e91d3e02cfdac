"""A corpus from ``documents``: judged, freed of repeats and benchmarks, packed.

Each stage takes the documents that the one before it kept, written as Parquet
and read again.  All but the last return the columns of ``documents``.

Rows with odd values: a null or empty text has too few words and goes in the
first stage; should a later stage meet one, it keeps it as it is.  A row without
a doc_id is judged for its text by the first and the fourth stage and otherwise
kept, as nothing can be said of its order.  Rows of equal doc_id go or stay by
their own texts, but near-duplicates take them for one document.  Columns of
any other names are carried along; an empty table stays empty.

The first stage leaves the session with short Arrow batches, as its result is
made when it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.llm import decontaminate, line_chunks, neardup, packing, quality
from isoframe.llm.scratch import short_batches, written
from isoframe.llm.tokens import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the trained classifier accept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    short_batches(spark)
    return quality.keep(docs, quality.train(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without line chunks that an earlier one has."""
    cut = line_chunks.without_repeated_chunks(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group of near-duplicates, on five-word shingles."""
    gone = neardup.near_duplicates(docs, 5).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: The stages train a model and count tokens, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
