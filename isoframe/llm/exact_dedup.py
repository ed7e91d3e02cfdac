"""Exact copies by deterministic block naming (operator 12), in DataFrame functions only.

A text's bytes are cut into blocks of BLOCK bytes, the last one shorter.  All
distinct blocks are sorted and numbered; a block's name is its number.  Then
names next to each other are paired, the distinct pairs are sorted and numbered
in turn, and so on until each text has one name.  Equal names mean equal pairs
and equal pairs mean equal bytes, so a name and the number of blocks (which
fixes the rounds) identify a text without any chance of collision.

Names are numbers within sorted partitions of distinct values, in one job with
their join to where the values occur, so a task that runs again gives the same.
Only blocks cross the network, never a whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.skew import FEW, SHARES, dealt_join

#: Bytes of a block.
BLOCK = 1024
#: Stands for the missing right half of an odd last pair; no name is so low.
NOTHING = -(1 << 62)


def _with(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def blocks(text: Column) -> Column:
    """The blocks of a text's bytes; an empty text has one, of no bytes."""
    places = F.sequence(F.lit(0), F.floor(F.greatest(F.octet_length(text) - 1, F.lit(0)) / BLOCK).cast("int"))
    return _with(text.cast("binary"), lambda b: F.transform(places, lambda i: F.substring(b, i * BLOCK + 1, F.lit(BLOCK))))


def named(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` with ``name``, a number for each distinct combination of values,
    in place of the values.

    Values of more than a thousandth of all rows (fewer than SHARES, seen by a
    hash; an equal hash only makes another value common) are numbered below
    zero and joined where the rows are; the others meet their names by a
    shuffle.  Both joins compare the values themselves.
    """
    others = [c for c in rows.columns if c not in values]
    counts = rows.select(F.xxhash64(*values).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).head()[0] if (found := counts.where(F.col("n") > FEW).orderBy(F.desc("n")).limit(SHARES).collect()) else 0
    common = [r["h"] for r in found if r["n"] * SHARES > total]
    is_common = F.xxhash64(*values).isin(common)
    rare = rows.where(~is_common) if common else rows
    names = rare.select(values).distinct().sortWithinPartitions(*values).withColumn("name", F.monotonically_increasing_id())
    out = rare.join(names, values).select(*others, "name")
    if not common:
        return out
    # Fewer than SHARES values of BLOCK bytes at most, but for equal hashes.
    numbers = rows.where(is_common).select(values).distinct().orderBy(*values).withColumn("name", -1 - F.monotonically_increasing_id())
    numbers = F.broadcast(written(numbers, "common-names"))
    return out.unionByName(rows.where(is_common).join(numbers, values).select(*others, "name"))


def identities(docs: DataFrame) -> DataFrame:
    """row, doc_id, text_sha256, n (blocks), name for each row of ``docs``.

    ``docs`` is read up to three times and must give its rows in the same order, as
    a table does.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.select("row", "doc_id", F.sha2("text", 256).alias("sha"), blocks(F.col("text")).alias("blocks"))
    cut = rows.select("row", "doc_id", "sha", F.size("blocks").alias("n"), F.posexplode("blocks").alias("place", "block"))
    # A document's own columns go with its first block.
    first = F.col("place") == 0
    now = written(named(cut.select("row", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("sha")).alias("sha"), "n", "place", "block"), ["block"]), "block-names")
    heads = now.where("place = 0").select("row", "doc_id", F.col("sha").alias("text_sha256"), "n", "name")
    longest = now.agg(F.max("n")).head()[0] or 0
    done, width = None, 1
    while width < longest:
        # A text's n blocks make ceil(n / width) names by now; with one it is done.
        open_ = now.where(F.col("n") > width)
        half = lambda odd: F.max(F.when(F.col("place") % 2 == odd, F.col("name")))
        pairs = open_.groupBy("row", "n", F.floor(F.col("place") / 2).cast("int").alias("place")).agg(half(0).alias("left"), F.coalesce(half(1), F.lit(NOTHING)).alias("right"))
        width *= 2
        now = written(named(written(pairs, "pairs"), ["left", "right"]), "pair-names")
        ended = now.where(F.col("n") <= width).select("row", "name")
        done = ended if done is None else done.unionByName(ended)
    if done is None:
        return heads
    several = heads.where("n > 1").drop("name").join(done, "row")
    return heads.where("n = 1").unionByName(several)


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for each row of ``docs``.

    Rows of equal texts form a group; the one with the largest doc_id stays.
    A null text counts as an empty one, and empty texts are equal.  A null
    doc_id is below all others: such a row stays only in a group of such rows,
    whose keep_id is null.  Of several rows with the largest doc_id the last
    one read stays, so each group keeps one row.  Other columns are left out;
    an empty table gives none.
    """
    rows = written(identities(docs), "identities")
    groups = rows.groupBy("n", "name").agg(F.max(F.struct("doc_id", "row")).alias("stays"), F.count("*").alias("group_size"))
    joined = dealt_join(rows, written(groups, "groups"), ["n", "name"])
    return joined.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("stays.row")).alias("kept"), "text_sha256")


def unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns, whatever their names.

    Rows with equal doc_id and text are one document and stay as one row.
    """
    stays = copies(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_, text = (f"c{docs.columns.index(name)}" for name in ("doc_id", "text"))
    sha = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    same = (F.col("kept_sha") == F.col("sha")) & F.col("kept_id").eqNullSafe(F.col(id_).cast("long"))
    rows = plain.withColumn("sha", sha).dropDuplicates(["sha", id_]).join(stays, same, "left_semi").drop("sha")
    return rows.toDF(*docs.columns)
