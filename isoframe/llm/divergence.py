"""How far the sources of a language differ in their words (operator 11).

For two sources the value is a sum over all terms that the language keeps, most
of which neither source has.  By inclusion and exclusion over the terms that
each has (its support) it is

    terms of the first, priced as if the other lacked them
  + terms of the second, likewise
  + for terms that both have, what was counted wrongly
  + a constant for each term that neither has.

The price of a term that one side lacks depends on its count alone, so the first
two sums come from a histogram of counts for each source, not from its terms.
The third needs a join of the terms' postings, which meets shared terms only.

All arithmetic is exact, on integers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.textkit import arrow_slices

#: A language keeps the terms in at least so many of its documents.
LEAST_DOCUMENTS = 10
#: Terms reported for each source.
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Terms that a task holds before it hands on their counts.
HELD = 500_000
#: Characters that a term consists of, as the task states them.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same for UTF-8: other characters' bytes become spaces, A-Z becomes a-z.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def share(count: Column, total: Column, terms: Column) -> Column:
    """A count's smoothed share of its group, times SCALE, rounded down, plus 1.

    Null if there are no terms.  In decimals, as a count of billions times
    SCALE is beyond a long.
    """
    product = (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", product, F.nullif((total + 2 * terms).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)")))
    return whole.cast("long") + 1


def divergence(p: Column, q: Column) -> Column:
    """One term's part of the distance of two shares, rounded down."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), n_docs of documents without nulls.

    Each task sums what it reads, up to HELD terms at a time, before rows are
    shuffled.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # By lang and source: occurrences and documents of each term.
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, n_docs) in held.items():
                terms = list(n)
                columns = [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array(map(n_docs.__getitem__, terms), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "n_docs"])
            held.clear()

        for batch in batches:
            langs, sources = (batch.column(k).to_pylist() for k in (0, 1))
            for begin, end, texts in arrow_slices(batch.column(2)):
                for group, text in zip(zip(langs[begin:end], sources[begin:end], strict=True), texts, strict=True):
                    terms = text.translate(TERM_BYTES).split()
                    n, n_docs = held[group]
                    n.update(terms)
                    n_docs.update(set(terms))
                if sum(len(n) for n, _ in held.values()) > HELD:
                    yield from emptied()
        yield from emptied()

    found = docs.select("lang", "source", "text").mapInArrow(rows, "lang string, source string, term string, n long, n_docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def postings(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two written tables: kept terms by source, and the sources.

    The first has lang, source, term, n, lang_n (occurrences in the language),
    p, lang_p (shares); the second lang, source, terms (kept by the language), own
    (terms it has) and p0 (share of a term that it lacks).
    """
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    docs = docs.select(*columns)
    # At most one row for each source, so a term that all have isn't a long one.
    of_term = Window.partitionBy("lang", "term")
    found = counted(docs).withColumn("lang_docs", F.sum("n_docs").over(of_term)).withColumn("lang_n", F.sum("n").over(of_term))
    kept = written(found.where(F.col("lang_docs") >= LEAST_DOCUMENTS).drop("n_docs", "lang_docs"), "kept-terms")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    of_lang = kept.groupBy("lang").agg(F.countDistinct("term").alias("terms"), F.sum("n").alias("lang_total"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = groups.select("lang", "source", *(zero(c) for c in ("total", "own", "terms", "lang_total")))
    groups = written(groups.withColumn("p0", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "sources")
    sizes = groups.select("lang", "source", "total", "terms", "lang_total")
    shares = kept.join(sizes, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    shares = shares.withColumn("lang_p", share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
    return written(shares.drop("total", "terms", "lang_total"), "postings"), groups.drop("total", "lang_total")


def source_pairs(posted: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, other, value: the distance of each two sources of a language.

    The sum of ``divergence`` over all terms of the language; each pair both ways.
    """
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("source", "own", "p0")]
    # As many rows as the result asks for, half of them.
    pairs = groups.select("lang", "terms", *side("a")).join(groups.select("lang", *side("b")), "lang").where("source_a < source_b")
    a0, b0 = F.col("p0_a"), F.col("p0_b")
    neither = (F.col("terms") - F.col("own_a") - F.col("own_b")) * divergence(a0, b0)
    constant = pairs.select("lang", "source_a", "source_b", F.coalesce(neither, F.lit(0).cast("long")).alias("value"))
    histogram = posted.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))

    def one_sided(mine: str, other: str) -> DataFrame:
        priced = pairs.join(histogram.withColumnRenamed("source", f"source_{mine}"), ["lang", f"source_{mine}"])
        return priced.select("lang", "source_a", "source_b", (F.col("k") * divergence(F.col("p"), F.col(f"p0_{other}"))).alias("value"))

    with_p0 = posted.select("lang", "source", "term", "p").join(groups.select("lang", "source", "p0"), ["lang", "source"])
    left, right = (with_p0.select("lang", "term", *(F.col(c).alias(f"{c}_{x}") for c in ("source", "p", "p0"))) for x in "ab")
    both = left.join(right, ["lang", "term"]).where("source_a < source_b")
    p, q = F.col("p_a"), F.col("p_b")
    wrong = divergence(p, q) - divergence(p, b0) - divergence(a0, q) + divergence(a0, b0)
    correction = both.select("lang", "source_a", "source_b", wrong.alias("value"))
    parts = constant.unionByName(one_sided("a", "b")).unionByName(one_sided("b", "a")).unionByName(correction)
    sums = written(parts.groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value")), "source-pairs")
    way = lambda x, y: sums.select("lang", F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("other"), "value")
    return way("a", "b").unionByName(way("b", "a"))


def telling_terms(posted: DataFrame) -> DataFrame:
    """lang, source, term, value of terms that a source has above its language's share."""
    return posted.where("p > lang_p").select("lang", "source", "term", divergence(F.col("p"), F.col("lang_p")).alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank for each (lang, source) of ``docs``.

    Part ``pair``: the other sources of the language by distance, all of them.
    Part ``term``: the TOP_TERMS terms that tell the source from its language.
    Ranks run from 1, value descending, item ascending.  Null text, lang and
    source count as empty strings.  Repeated rows count as often as they
    occur.  A source whose texts have no kept term is compared nonetheless; in
    a language without any, distances are 0.  Other columns play no part; an
    empty table gives no rows.
    """
    posted, groups = postings(docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    pairs = ranked(source_pairs(posted, groups).withColumnRenamed("other", "item"), "pair")
    # The ranks' limit is applied before rows are shuffled, too.
    terms = ranked(telling_terms(posted).withColumnRenamed("term", "item"), "term").where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(terms)
