"""MinHash near-duplicates with tensored banding (operator 6).

Each text's shingle set is hashed into COLLECTIONS small collections of ROWS
minhashes.  Every pair of collections is a table whose key combines the two,
so 28 minhashes feed 91 tables of four rows, where plain banding would need
364.  Two sets of Jaccard similarity 0.8 share no key with probability 1.6e-5.

Candidates are confirmed on full sets, without listing all pairs of a group:

1. Equal sets form a class, represented by its least document.
2. In each bucket every set is compared with three others, the same for all:
   the least, the greatest and one by hash.  Confirmed links give components.
3. Buckets that still hold several components are compared in blocks: sets
   outside the bucket's largest component are the queries, all its sets are
   compared with them, and pairs within a component are passed over.  So each
   pair that shares a key is either connected already or compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoframe.llm.components import components
from isoframe.llm.scratch import written
from isoframe.llm.skew import dealt_join
from isoframe.llm.textkit import U64, Texts, encoded, shingle_sets, slices

COLLECTIONS, ROWS = 14, 2
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Queries and compared sets of a block, on average.
QUERIES, COMPARED = 512, 512
#: Shingles hashed at once.
HASHED = 1 << 14

_RNG = np.random.Generator(np.random.PCG64(77))
_MULTIPLY = _RNG.integers(1, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _RNG.integers(0, 1 << 63, COLLECTIONS * ROWS, dtype=np.uint64)
_FOLD = U64(0x9E3779B97F4A7C15)


def _collections(shingles: np.ndarray) -> np.ndarray:
    """One hash for each collection: its minhashes combined."""
    least = np.full(COLLECTIONS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), HASHED):
        np.minimum(least, (shingles[low : low + HASHED, None] * _MULTIPLY + _ADD).min(0), out=least)
    least = least.reshape(COLLECTIONS, ROWS)
    out = least[:, 0]
    for r in range(1, ROWS):
        out = (out ^ (out >> U64(31))) * _FOLD + least[:, r]
    return out.view(np.int64)


def _sets(strings, k: int) -> Iterator[np.ndarray]:
    raw = encoded(strings)
    for a, b in slices(raw):
        yield from shingle_sets(Texts(raw[a:b], lower=True), k)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, two sums that tell sets apart, and collections."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for s in _sets(batch.text, k):
                if len(s):
                    sums = (s.sum(dtype=U64), (s * (s | U64(1))).sum(dtype=U64) ^ np.bitwise_xor.reduce(s))
                    rows.append((len(s), *(int(x.view(np.int64)) for x in sums), _collections(s)))
                else:
                    rows.append((0, 0, 0, None))
            yield pd.DataFrame(rows, columns=["n_shingles", "sum_1", "sum_2", "hashes"]).assign(doc_id=batch.doc_id.astype("Int64").to_numpy())

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInPandas(sign, "n_shingles long, sum_1 long, sum_2 long, hashes array<long>, doc_id long")


def _keys(leaders: DataFrame) -> DataFrame:
    """key, doc: the tables' keys of each set, for keys that others may have.

    A collection's hash that only one set has can be part of no shared key, so
    those are dropped before the pairs are formed.
    """
    single = leaders.select(F.col("doc_id").alias("doc"), F.posexplode("hashes").alias("i", "h"))
    shared = single.groupBy("i", "h").agg(F.count("*").alias("n")).where("n > 1").select("i", "h")
    kept = dealt_join(single, shared, ["i", "h"]).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("i", "h"))).alias("c"))
    pairs = F.expr("flatten(transform(c, (x, p) -> transform(slice(c, p + 2, size(c)), y -> xxhash64(x.i, y.i, x.h, y.h))))")
    return kept.select("doc", F.explode(pairs).alias("key"))


def _linked(strings: list[str], others: list[str], k: int) -> Iterator[tuple[int, int]]:
    """Pairs of a query and another text whose sets are similar enough."""
    queries = list(_sets(strings, k))
    sizes = np.array([len(q) for q in queries], np.int64)
    owner = np.repeat(np.arange(len(queries)), sizes)
    values = np.concatenate(queries)
    order = np.argsort(values, kind="stable")
    owner = owner[order]
    vocabulary, first = np.unique(values[order], return_index=True)
    first = np.append(first, len(values))
    for j, s in enumerate(_sets(others, k)):
        at = np.minimum(np.searchsorted(vocabulary, s), len(vocabulary) - 1)
        at = at[vocabulary[at] == s]
        length = first[at + 1] - first[at]
        inside = np.arange(length.sum()) + np.repeat(first[at] - np.cumsum(length) + length, length)
        both = np.bincount(owner[inside], minlength=len(queries))
        for i in np.flatnonzero(100 * both >= PERCENT * (sizes + len(s) - both)):
            yield int(i), j


def _star_links(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Those pairs (doc, pivot) that are links."""

    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for a, b, s, t in zip(batch["doc"], batch["pivot"], _sets(batch.text, k), _sets(batch.pivot_text, k), strict=True):
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= PERCENT * (len(s) + len(t) - both):
                    found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"])

    pivots = texts.select(F.col("doc").alias("pivot"), F.col("text").alias("pivot_text"))
    # A pivot meets its whole bucket.
    return dealt_join(pairs, pivots, ["pivot"]).join(texts, "doc").select("doc", "pivot", "text", "pivot_text").mapInPandas(confirm, "a long, b long")


def _block_links(keys: DataFrame, labels: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Links between different components within a bucket."""
    labelled = keys.join(labels.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("label"))
    labelled = written(labelled, "labelled-keys")
    counts = labelled.groupBy("key", "label").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc")).alias("sign"))
    mixed = (
        counts.groupBy("key")
        .agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.max_by("label", F.struct("n", "label")).alias("largest"), F.max("n").alias("most"), F.bit_xor("sign").alias("sign"))
        .where("labels > 1")
    )
    # Buckets with the same sets need one comparison.
    mixed = mixed.groupBy("n", "sign", "largest", "most").agg(F.min("key").alias("key"))
    rows = dealt_join(labelled, written(mixed, "mixed-buckets"), ["key"]).withColumn("is_query", F.col("label") != F.col("largest"))
    rows = rows.withColumn("query_blocks", F.ceil((F.col("n") - F.col("most")) / QUERIES)).withColumn("blocks", F.ceil(F.col("n") / COMPARED))
    deal = lambda by, salt: F.pmod(F.xxhash64("doc", F.lit(salt)), F.col(by))
    every = lambda by: F.explode(F.sequence(F.lit(0).cast("long"), F.col(by) - 1))
    queries = rows.where("is_query").select("key", "doc", "label", F.lit(True).alias("is_query"), deal("query_blocks", 1).alias("q"), every("blocks").alias("c"))
    compared = rows.select("key", "doc", "label", F.lit(False).alias("is_query"), every("query_blocks").alias("q"), deal("blocks", 2).alias("c"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        queries, compared = group[group.is_query], group[~group.is_query]
        found = []
        if len(queries) and len(compared):
            label_q, label_c = queries.label.to_numpy(), compared.label.to_numpy()
            doc_q, doc_c = queries.doc.to_numpy(), compared.doc.to_numpy()
            # One link for each two components is enough to join them.
            seen = set()
            for i, j in _linked(list(queries.text), list(compared.text), k):
                two = (min(label_q[i], label_c[j]), max(label_q[i], label_c[j]))
                if two[0] != two[1] and two not in seen:
                    seen.add(two)
                    found.append((doc_q[i], doc_c[j]))
        return pd.DataFrame(found, columns=["a", "b"])

    return queries.union(compared).join(texts, "doc").groupBy("key", "q", "c").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Words are runs of characters other than space and 0x09-0x0D, with A-Z in
    lower case; a set holds the distinct k-word shingles, or the whole sequence
    where there are fewer words.  Null and empty texts have no shingles and are
    linked with nothing.  component_id is the least doc_id that links reach.
    Rows with the same doc_id are one document, which has the links of each of
    them; each row still gets its own result.  A null doc_id has a null
    component and is kept.  Columns of other names are ignored.
    """
    signed = written(signatures(docs, k), "signatures")
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "sum_1", "sum_2"]
    classes = written(full.groupBy(*same).agg(F.min("doc_id").alias("doc")), "classes")
    members = written(dealt_join(full.select("doc_id", *same), classes, same).select("doc_id", "doc").distinct(), "members")
    leaders = written(full.join(members.where("doc_id = doc").select("doc_id").distinct(), "doc_id", "left_semi"), "leaders")
    keys = written(_keys(leaders), "all-keys")
    pivots = F.array(F.min("doc"), F.max("doc"), F.min_by("doc", F.xxhash64("doc"))).alias("pivots")
    buckets = written(keys.groupBy("key").agg(F.count("*").alias("n"), pivots).where("n > 1").drop("n"), "buckets")
    keys = written(dealt_join(keys, buckets, ["key"]), "keys")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string"))
    texts = written(plain.join(keys.select("doc").distinct(), "doc"), "texts")
    pairs = keys.select("doc", F.explode(F.array_distinct("pivots")).alias("pivot")).where("doc <> pivot")
    # Either way round it is the same pair.
    pairs = pairs.groupBy(F.least("doc", "pivot").alias("low"), F.greatest("doc", "pivot").alias("high")).agg(F.max("pivot").alias("pivot"))
    pairs = written(pairs.select(F.when(F.col("pivot") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("doc"), "pivot"), "pairs")
    stars = written(_star_links(pairs, texts, k), "star-links")
    more = _block_links(keys.select("key", "doc"), components(stars), texts, k)
    # A document that several rows have belongs to all their classes.
    several = members.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("doc").alias("least"), F.collect_set("doc").alias("docs")).where("n > 1")
    tied = several.select(F.explode("docs").alias("a"), F.col("least").alias("b"))
    found = components(stars.union(written(more, "block-links")).union(tied))
    # Classes first, then the documents of each.
    of_class = classes.select("doc").distinct().join(found, F.col("doc") == F.col("node"), "left").select("doc", F.coalesce("component", "doc").alias("component"))
    of_doc = dealt_join(members, of_class, ["doc"]).groupBy("doc_id").agg(F.min("component").alias("component"))
    out = signed.select("doc_id", "n_shingles").join(of_doc, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
