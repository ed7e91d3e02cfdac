"""Removal of repeated line chunks (operator 2), in DataFrame functions only.

A rolling hash over the hashes of two lines in a row ends a chunk where it is
less than on the line before and not more than on the line after, so a chunk's
bounds depend on its own lines and lines put in or left out elsewhere don't
shift them.  Chunks have two lines at least, where the text has, and three on
average.  Those that occur again are removed after their bytes are compared; the
first by (doc_id, place) stays.

Chunks live in one string per text: each line is led by a space, lines of a
chunk are joined by one line end and chunks by two.  A line holds no line end,
so two in a row are found between chunks only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.skew import dealt_join

#: Values of the rolling hash, and the weights of a line and the one before.
VALUES, WEIGHTS = 1_000_003, (7, 3)


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def chunks(text: Column) -> Column:
    """The chunks of a text as an array of strings, null for a null text."""
    lines = F.split(text, "\n")
    line_hash = lambda line: F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")

    def joined(lines: Column) -> Column:
        def cut(r: Column) -> Column:
            # Null beyond the text, so that its first line ends no chunk.
            ends = lambda i: (F.get(r, i) < F.get(r, i - 1)) & (F.get(r, i) <= F.get(r, i + 1))
            between = lambda i: F.when(i == 0, "").when(ends(i - 1), "\n\n").otherwise("\n")
            return F.array_join(F.transform(lines, lambda line, i: F.concat(between(i), F.lit(" "), line)), "")

        def rolled(h: Column) -> Column:
            roll = lambda x, i: (WEIGHTS[0] * x + WEIGHTS[1] * F.coalesce(F.get(h, i - 1), F.lit(0))) % VALUES
            return _with(F.transform(h, roll), cut)

        return _with(F.transform(lines, line_hash), rolled)

    return F.split(_with(lines, joined), "\n\n")


def _text(chunks: Column) -> Column:
    return F.array_join(F.transform(chunks, lambda c: F.substr(F.replace(c, F.lit("\n "), F.lit("\n")), F.lit(2))), "\n")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, place, hash of each chunk that is to be removed."""
    all_chunks = docs.where("doc_id IS NOT NULL").select("doc_id", F.posexplode(chunks(F.col("text"))).alias("place", "chunk"))
    long = all_chunks.where(F.instr("chunk", "\n") > 0).withColumn("hash", F.xxhash64("chunk"))
    where = F.struct("doc_id", "place")
    twice = long.groupBy("hash").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").select("hash")
    candidates = written(dealt_join(written(long, "chunks"), twice, ["hash"], "left_semi"), "candidates")
    firsts = candidates.groupBy("hash", F.col("chunk").alias("first_chunk")).agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first <> last").drop("last")
    # Dealt by their hashes, then equal byte for byte.
    same = dealt_join(candidates, written(firsts, "first-chunks"), ["hash"]).where(F.col("chunk") == F.col("first_chunk"))
    return same.where(where != F.col("first")).select("doc_id", "place", "hash")


def without_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated chunks cut from their texts, and n_chunks, n_removed.

    A null text stays null and has no chunks; a text that loses all its lines
    is empty.  A null doc_id has no order, so its row stands and makes nothing
    repeated.  Rows of equal doc_id and text are one occurrence.  All columns
    of ``docs`` are returned, with any names but n_chunks and n_removed, which
    are replaced.
    """
    # By place, so that no name can clash.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_, text = (f"c{docs.columns.index(name)}" for name in ("doc_id", "text"))
    removed = repeated_chunks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    # No more than a document's own chunks.
    by_doc = removed.distinct().groupBy(F.col("doc_id").alias("cut_id")).agg(F.collect_set(F.struct("place", "hash")).alias("removed"))
    joined = plain.join(by_doc, F.col(id_).cast("long") == F.col("cut_id"), "left")

    def kept(all_chunks: Column) -> Column:
        stays = lambda c, i: F.col("removed").isNull() | ~F.array_contains("removed", F.struct(i.alias("place"), F.xxhash64(c).alias("hash")))
        left = F.filter(all_chunks, stays)
        return F.struct(_text(left).alias("text"), F.size(all_chunks).alias("n"), F.size(left).alias("left"))

    none = F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("n"), F.lit(0).alias("left"))
    result = joined.withColumn("kept", F.when(F.col(text).isNull(), none).otherwise(_with(chunks(F.col(text).cast("string")), kept)))
    names = [F.col("kept.text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in ("n_chunks", "n_removed")]
    return result.select(*names, F.col("kept.n").cast("long").alias("n_chunks"), (F.col("kept.n") - F.col("kept.left")).cast("long").alias("n_removed"))
