"""The registered queries of the training-data operators.

Each runs its operator with production parameters over its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isoframe.llm import chat, decontaminate, divergence, exact_dedup, line_chunks, neardup, packing, passages, periodic, pii, quality, token_counts, token_output
from isoframe.llm.scratch import new_path
from isoframe.llm.tokens import vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 40 words or more that a document shares with an earlier one."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated line chunks, as digests."""
    kept = line_chunks.without_repeated_chunks(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_chunks", "n_removed", F.char_length("text").cast("long").alias("n_kept_chars"), F.md5("text").alias("kept_md5"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals and the trained classifier's verdict on every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted windows."""
    odd = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digests(chat.windows(turns))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose two-word shingle sets are 80 % alike."""
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), 2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text before and after edits to it."""
    return token_counts.edited_counts(_table(spark, sf_dir, "documents"), vocabulary())


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, but for a few edits."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written as compressed blocks and read back."""
    path = new_path(spark, "token-ids")
    token_output.write_tokens(_table(spark, sf_dir, "documents"), path, vocabulary())
    return token_output.read_tokens(spark, path)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of each language, and the terms that tell them apart."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts, and the row of each that stays."""
    return exact_dedup.copies(_table(spark, sf_dir, "documents"))


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id, text: some documents repeat what follows their word a, with period p.

    Those whose number's crc32 is divisible by ten, as the contract says.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i))), " ")).otherwise("")

    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(F.coalesce(h % 10 == 0, F.lit(False)), _with(words, repeated)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the periodic runs of every document, with some planted."""
    rows = periodic.periodic_runs(_planted(_table(spark, sf_dir, "documents")))
    # Runs come by start, then period, so the first of equals stays.
    above = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    kind = "struct<start:long,length:long,period:long>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda b, x: F.when(b.isNull() | above(x, b), x).otherwise(b))
    line = lambda r: F.concat_ws("", F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return rows.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_line_dedup, op3_quality_rules, op4_personal_data, op5_chat_formatting, op6_near_duplicates, op7_token_counts, op8_packing, op9_decontamination, op10_token_output, op11_source_divergence, op12_exact_dedup, op13_periodic_runs)
}
