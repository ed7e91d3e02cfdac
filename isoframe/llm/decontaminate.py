"""Benchmark decontamination by embedded edit distance (operator 9).

An item is found in a document where some passage has a word edit distance of
at most MAX_EDITS of the item's length from it.  Item-sized windows of the
documents and the items are embedded by the CGK random walk: a walk over the
words copies the word it stands on and moves on by a coin that the step and the
word decide, so a few edits leave most of the walk alike.  Repetition by
repetition, a few sampled steps of the embedding make a key; items and windows
that share a key are compared exactly.

The walks of long texts drift apart, so an item of 2 * PART words or more is
searched by its parts: of a passage within the edits of the item, some part is
within the edits of its own length.  A part's windows bring the text around
them that the whole item needs.

Windows are thinned before: an edit spoils at most two word pairs, so a window
that holds an item keeps (length - 1) - 2 * edits of the pairs that items of
this length have.  A pair that only repeats the one before counts where some
item has such a thing, too.  Of the windows' keys only those are kept that some
item may have, by a table of bits of fixed size.

Items of fewer than WALKED words need no walk.  Without an edit the window is the
item; with one, both are equal but for a word of each, so their hashes without
each word in turn are their keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.skew import dealt_join
from isoframe.llm.textkit import U64, Texts, arrow_slices, encoded, mix, runs, slices

#: Edits allowed, as a share of the item's words.
MAX_EDITS = 0.2
#: Words of the items that are searched, at least, and of those for which a
#: document is dropped: what is shorter may stand in any text.
MIN_WORDS, TELLING = 1, 8
#: Items of fewer words allow one edit at most and are found by equal hashes, not by walks.
WALKED = 8
#: Longer items are searched by parts of PART to 1.5 * PART words or so.
PART = 15
#: Sampled steps of each repetition of the embedding; see repeats().
STEPS = 3
#: Steps of a walk over n words, as a multiple of n.
WALK = 2
#: Rows that walk, and pairs that are compared, side by side.
BLOCK, COMPARED = 4096, 512
#: 2 ** PAIR_BITS buckets of word pairs, of eight bytes each, are sent to tasks.
PAIR_BITS = 20
#: 2 ** FILTER_BITS bits of keys that items have are sent to tasks, too.
FILTER_BITS = 24

KEYS = "doc_id long, start int, size int, keys array<long>, text string"


def repeats(length: int) -> int:
    """Repetitions with which 95 of 100 passages at MAX_EDITS share a key.

    Measured on random words, for substitutions, deletions, insertions and all.
    Of an item that isn't walked, the number of its exact keys.
    """
    if length < WALKED:
        return length if edits_allowed(length) else 1
    return 16 if length < 15 else 32 if length < 23 else 48


def parts(n: int) -> list[tuple[int, int]]:
    """Where the parts of an item of n words begin, and their lengths."""
    m = max(1, n // PART)
    bounds = [i * n // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def sampled(words: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """What CGK walks over rows of word hashes (rows, n) copy at sampled steps.

    ``steps`` (repetitions, samples) gives (repetitions, samples, rows) hashes.
    The repetitions walk side by side, up to the last sampled step.
    """
    rows, n = words.shape
    flat = np.concatenate([words, np.zeros((rows, 1), U64)], 1).ravel()
    line = np.arange(rows) * (n + 1)
    at = np.zeros((len(steps), rows), np.int64)
    out = np.empty((*steps.shape, rows), U64)
    repeat = np.arange(len(steps), dtype=U64)[:, None] * U64(1000003)
    for step in range(int(steps.max()) + 1):
        here = flat[line + at]
        r, j = np.nonzero(steps == step)
        out[r, j] = here[r]
        coin = mix(here + (repeat + U64(step + 1)) * U64(0x9E3779B97F4A7C15)) >> U64(63)
        at = np.minimum(at + coin.astype(np.int64), n)
    return out


@lru_cache(maxsize=256)
def _steps(length: int) -> np.ndarray:
    """Sampled steps (repetitions, samples) of walks over so many words."""
    return np.stack([np.random.Generator(np.random.PCG64([r, length])).choice(WALK * length, STEPS, replace=False) for r in range(repeats(length))])


def walk_keys(words: np.ndarray, length: int) -> np.ndarray:
    """Keys (rows, repetitions) of rows of ``length`` word hashes.

    The sampled steps are drawn anew for each repetition and length.  Equal
    rows walk once.
    """
    times = repeats(length)
    if length < WALKED:
        keys = np.empty((len(words), times), U64)
        for j in range(times):
            rest = np.delete(words, j, axis=1) if times > 1 else words
            keys[:, j] = U64(length)
            for k in range(rest.shape[1]):
                keys[:, j] = mix(keys[:, j] * U64(31) + rest[:, k])
        return keys
    steps = _steps(length)
    whole = np.ascontiguousarray(words).view(np.dtype((np.void, 8 * length))).ravel()
    _, first, back = np.unique(whole, return_index=True, return_inverse=True)
    keys = np.empty((len(first), times), U64)
    for low in range(0, len(first), BLOCK):
        walks = sampled(words[first[low : low + BLOCK]], steps)
        key = np.arange(times, dtype=U64)[:, None] * U64(7919) + U64(length)
        for j in range(STEPS):
            key = mix(key * U64(31) + walks[:, j])
        keys[low : low + BLOCK] = key.T
    return keys[back]


def keys_of(walked: np.ndarray, n: int, at: int) -> np.ndarray:
    """Keys for parts that begin at word ``at`` of items of ``n`` words."""
    return mix(walked + U64((n << 16) + (at << 40) + 1)).view(np.int64)


def edits_within(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edits that turn the item into a run of the text, and that run.

    Of equal ones the run that ends first; its start is the latest possible.
    """
    n, m = len(item), len(text)
    cost = np.zeros(m + 1, np.int64)
    begin = np.arange(m + 1)
    for i in range(1, n + 1):
        swap = cost[:-1] + (text != item[i - 1])
        drop = cost[1:] + 1
        new, start = np.empty(m + 1, np.int64), np.empty(m + 1, np.int64)
        new[0], start[0] = i, 0
        new[1:] = np.minimum(swap, drop)
        start[1:] = np.where(swap <= drop, begin[:-1], begin[1:])
        # Words of the text that the item lacks: a running least of new - place.
        shifted = new - np.arange(m + 1)
        least = np.minimum.accumulate(shifted)
        first = np.maximum.accumulate(np.where(shifted == least, np.arange(m + 1), 0))
        cost, begin = least + np.arange(m + 1), start[first]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def edits_of_many(items: list[np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Rows of ``edits_within`` for an item and a text each, side by side."""
    out = np.zeros((len(items), 3), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(items, texts, strict=True)], np.int64).reshape(-1, 2)
    # Alike sizes together, the longest items of a block first.
    order = np.lexsort((sizes[:, 1], sizes[:, 0]))[::-1]
    for low in range(0, len(order), COMPARED):
        rows = order[low : low + COMPARED]
        n, m = sizes[rows].T
        item, text = np.zeros((len(rows), n.max()), U64), np.zeros((len(rows), m.max()), U64)
        for k, r in enumerate(rows.tolist()):
            item[k, : n[k]], text[k, : m[k]] = items[r], texts[r]
        places = np.arange(m.max() + 1, dtype=np.int32)
        cost = np.zeros((len(rows), len(places)), np.int32)
        begin = np.repeat(places[None], len(rows), 0)
        for i in range(1, int(n.max()) + 1):
            # Rows whose item has so many words come first.
            r = int(np.count_nonzero(n >= i))
            swap = cost[:r, :-1] + (text[:r] != item[:r, i - 1 : i])
            drop = cost[:r, 1:] + 1
            new, start = np.empty((r, len(places)), np.int32), np.zeros((r, len(places)), np.int32)
            new[:, 0] = i
            np.minimum(swap, drop, out=new[:, 1:])
            start[:, 1:] = np.where(swap <= drop, begin[:r, :-1], begin[:r, 1:])
            new -= places
            least = np.minimum.accumulate(new, 1)
            first = np.maximum.accumulate(np.where(new == least, places, 0), 1)
            cost[:r], begin[:r] = least + places, np.take_along_axis(start, first, 1)
        end = np.where(places > m[:, None], np.int32(1 << 30), cost).argmin(1)
        line = np.arange(len(rows))
        out[rows] = np.stack([cost[line, end], begin[line, end], end], 1)
    return out


def _items(benchmark: DataFrame, min_words: int) -> DataFrame:
    """item_id, n_words, keys, keys of the walks alone and text of items of so many words."""

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item_id, text in zip(batch.item_id.astype("object"), batch.text, strict=True):
                t = Texts(encoded([text]), lower=True)
                if len(t.start) >= min_words:
                    words, n = t.words()[None, :], len(t.start)
                    walked = [(a, walk_keys(words[:, a : a + size], size)[0]) for a, size in parts(n)]
                    keys = np.concatenate([keys_of(w, n, a) for a, w in walked])
                    out.append((item_id, n, keys, np.concatenate([w for _, w in walked]).view(np.int64), text))
            yield pd.DataFrame(out, columns=["item_id", "n_words", "keys", "walked", "item"]).astype({"item_id": "Int64"})

    plain = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInPandas(key, "item_id long, n_words int, keys array<long>, walked array<long>, item string")


def _repeated(pairs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Pairs that are the same as the one that begins a word before."""
    out = np.zeros(len(pairs), bool)
    out[1:] = (pairs[1:] == pairs[:-1]) & (np.diff(at) == 1)
    return out


def _pair_table(items: DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """The items' lengths, for each bucket of pairs which lengths have it, and
    whether some item has one word three times in a row.

    Bit i of a bucket stands for lengths i, i + 64 and so on.  The sizes don't
    grow with the benchmark: there are no more rows than buckets and bits.
    """

    def buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            t = Texts(encoded(batch["item"]), lower=True)
            pairs, at = runs(t.words(), t.doc, 2)
            yield pd.DataFrame({"bucket": (pairs >> U64(64 - PAIR_BITS)).astype(np.int64), "n_words": batch.n_words.to_numpy()[t.doc[at]], "again": _repeated(pairs, at)})

    table = np.zeros(1 << PAIR_BITS, U64)
    rows = items.select("item", "n_words").mapInPandas(buckets, "bucket long, n_words int, again boolean")
    again = False
    for r in rows.groupBy("bucket").agg(F.collect_set(F.pmod("n_words", F.lit(64))).alias("bits"), F.bool_or("again").alias("again")).collect():
        table[r["bucket"]] = U64(sum(1 << b for b in r["bits"]))
        again |= r["again"]
    lengths = sorted(r["n_words"] for r in items.select("n_words").distinct().collect())
    return np.array(lengths, np.int64), table, again


def _known_keys(items: DataFrame) -> np.ndarray:
    """Bits of the buckets of walk keys that items have: 2 ** FILTER_BITS of them.

    A window without such a key meets no item; a bucket met by chance costs a
    comparison of keys.  The size doesn't grow with the benchmark.
    """
    buckets = items.select(F.explode("walked").alias("key")).select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("bucket"))
    bit = F.expr("shiftleft(1L, int(bucket & 63))")
    # At most 2 ** (FILTER_BITS - 6) rows of two numbers.
    rows = buckets.groupBy(F.shiftright("bucket", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), U64)
    table[rows.word.to_numpy(np.int64)] = rows.bits.to_numpy(np.int64).view(U64)
    return table


def _hits(walked: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys lie in a bucket that items have."""
    bucket = walked >> U64(64 - FILTER_BITS)
    return (known[bucket >> U64(6)] >> (bucket & U64(63))) & U64(1) > 0


def edits_allowed(length):
    return np.floor(MAX_EDITS * length).astype(np.int64) if isinstance(length, np.ndarray) else int(MAX_EDITS * length)


def _starts(t: Texts, words: np.ndarray, lengths: np.ndarray, table: np.ndarray, again: bool) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Items' length, a part's place and length, starts and ends of windows that may hold it.

    The window must have enough pairs for the part, and the text around it
    for the whole item.
    """
    pairs, at = runs(words, t.doc, 2)
    have = np.zeros(len(words), U64)
    have[at] = table[pairs >> U64(64 - PAIR_BITS)]
    if not again:
        have[at[_repeated(pairs, at)]] = 0
    sizes = [(n, size) for n in lengths.tolist() for size in sorted({size for _, size in parts(n)})]
    # Texts without as many pairs of any items as the least that suffice are out.
    total = np.concatenate([[0], np.cumsum(have != 0)])[t.first]
    full = np.repeat(np.diff(total) >= min((size - 1 - 2 * edits_allowed(size) for _, size in sizes), default=1 << 40), np.diff(t.first))
    # Within the longest window from a place there must be as many as any needs.
    counted = np.concatenate([[0], np.cumsum(have != 0)])
    ahead = np.minimum(np.arange(len(words)) + max((size for _, size in sizes), default=0), len(words))
    least = min((size - 1 - 2 * edits_allowed(size) for _, size in sizes), default=1 << 40)
    place = np.flatnonzero(full & (counted[ahead] - counted[:-1] >= least))
    room = t.first[t.doc[place] + 1] - place
    for n, length in sizes:
        edits = edits_allowed(length)
        before = np.concatenate([[0], np.cumsum((have >> U64(n % 64)) & U64(1), dtype=np.int64)])
        # A window may reach the text's end, and is shorter then.
        size = np.minimum(room, length)
        held = before[place + size - 1] - before[place]
        may = np.flatnonzero((held >= length - 1 - 2 * edits) & (size >= length - edits))
        if not len(may):
            continue
        start, end, doc = place[may], place[may] + size[may], t.doc[place[may]]
        spare = edits_allowed(n)
        for at in (at for at, part in parts(n) if part == length):
            low = np.maximum(start - at - spare, t.first[doc])
            high = np.minimum(start + n - at + spare, t.first[doc + 1])
            ok = before[high - 1] - before[low] >= n - 1 - 2 * spare
            if ok.any():
                yield n, at, length, start[ok], end[ok]


def _joined(met: list[tuple]) -> Iterator[tuple]:
    """Windows of a text for items of one length that begin near each other, as
    one, with the keys of all: doc, length, first and last word, keys.

    A passage brings a window for each place from which its keys are met.
    """
    met.sort(key=lambda x: x[:3])
    k = 0
    while k < len(met):
        doc, n, low, high, _ = met[k]
        last = k
        while last < len(met) and met[last][:2] == (doc, n) and met[last][2] <= low + n // 2:
            high = max(high, met[last][3])
            last += 1
        yield doc, n, low, high, np.unique(np.concatenate([x[4] for x in met[k:last]]))
        k = last


def _windows(docs: DataFrame, lengths: np.ndarray, table: np.ndarray, again: bool, known: np.ndarray) -> DataFrame:
    """Windows that share a key with an item: the keys, and their text with margins."""
    # All are bounded; see _pair_table and _known_keys.
    shared = docs.sparkSession.sparkContext.broadcast((lengths, table, again, known))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, table, again, known = shared.value
        for batch in batches:
            ids = batch.column("doc_id")
            for a, b, raw in arrow_slices(batch.column("text")):
                t = Texts(raw, lower=True)
                words, rows, seen, met = t.words(), [], set(), []
                by_length: dict[int, list[tuple[int, int, np.ndarray, np.ndarray]]] = {}
                for n, at, length, start, end in _starts(t, words, lengths, table, again):
                    by_length.setdefault(length, []).append((n, at, start, end))
                for length, found in by_length.items():
                    start, end = (np.concatenate([f[k] for f in found]) for k in (2, 3))
                    size, part = (np.repeat([f[k] for f in found], [len(f[2]) for f in found]) for k in (0, 1))
                    # One walk for each place, whatever items it may hold.
                    place, first, back = np.unique(start, return_index=True, return_inverse=True)
                    inside = place[:, None] + np.arange(length)
                    walked = walk_keys(np.where(inside < end[first, None], words[np.minimum(inside, len(words) - 1)], U64(0)), length)
                    hits = _hits(walked, known)
                    for r in np.flatnonzero(hits.any(1)[back]).tolist():
                        n, at, doc, w = int(size[r]), int(part[r]), int(t.doc[start[r]]), back[r]
                        low = max(int(start[r]) - at - edits_allowed(n), int(t.first[doc]))
                        high = min(int(end[r]) + n - at - length + edits_allowed(n), int(t.first[doc + 1]))
                        met.append((doc, n, low, high, keys_of(walked[w, hits[w]], n, at)))
                for doc, n, low, high, keys in _joined(met):
                    text = t.buf[t.start[low] : t.end[high - 1]].tobytes()
                    # Text that repeats itself gives equal windows; the first counts.
                    if (doc, n, text) not in seen:
                        seen.add((doc, n, text))
                        rows.append((a + doc, low - int(t.first[doc]), n, keys, text))
                if rows:
                    doc, *columns = zip(*rows)
                    arrays = [pa.array(x, kind) for x, kind in zip(columns, (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(doc)), *arrays[:3], arrays[3].cast(pa.string())], ["doc_id", "start", "size", "keys", "text"])

    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(cut, KEYS)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, item_id, start, end, edits of each item that a document holds.

    start and end are word places of the best passage, end exclusive.  Words
    are runs of characters other than space and 0x09-0x0D, with A-Z in lower
    case.  Null or empty texts hold nothing, nor are items
    without words, or of fewer than ``min_words``, held;
    rows with a null id are searched and reported with it.  Repeated rows give
    one result for each doc_id and item.
    """
    items = written(_items(benchmark, min_words), "items")
    windows = written(_windows(docs, *_pair_table(items), _known_keys(items)), "windows")
    # The keys are met first without texts; then each candidate once.  A key, an
    # item or a window's text that much of the table has is dealt over parts.
    named = items.withColumn("i", F.xxhash64("item_id", "item"))
    item_keys = named.select("i", F.explode("keys").alias("key")).distinct()
    window_keys = written(windows.select(F.xxhash64("text").alias("t"), F.explode("keys").alias("key")).distinct(), "window-keys")
    met = written(dealt_join(window_keys, item_keys, ["key"]).select("t", "i").distinct(), "candidates")
    pairs = dealt_join(met, named.select("i", "item_id", "item").distinct(), ["i"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [x for two in zip(encoded(batch["item"]), encoded(batch.text), strict=True) for x in two]
            found = []
            for low, high in slices([raw[k] + raw[k + 1] for k in range(0, len(raw), 2)]):
                t = Texts(raw[2 * low : 2 * high], lower=True)
                parts_ = np.split(t.words(), t.first[1:-1])
                words = np.array([len(x) for x in parts_[::2]], np.int64)
                found.append(np.column_stack([edits_of_many(parts_[::2], parts_[1::2]), words]))
            out = batch[["t", "item_id"]].astype({"item_id": "Int64"})
            found = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
            out[["edits", "a", "b"]] = found[:, :3]
            yield out[found[:, 0] <= edits_allowed(found[:, 3])][["t", "item_id", "a", "b", "edits"]]
    texts = windows.select(F.xxhash64("text").alias("t"), "text").groupBy("t").agg(F.first("text").alias("text"))
    matches = pairs.join(texts, "t").mapInPandas(compare, "t long, item_id long, a int, b int, edits int")
    places = windows.select("doc_id", "start", F.xxhash64("text").alias("t"))
    found = dealt_join(places, written(matches, "matches"), ["t"])
    best = F.min(F.struct("edits", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("end"))).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.start", "best.end", "best.edits")


def clean(docs: DataFrame, benchmark: DataFrame, min_words: int = TELLING) -> DataFrame:
    """Rows of ``docs`` that hold no item of ``min_words`` words or more, with all
    their columns, whatever their names.

    Each row is judged by its own text, so rows without a doc_id, and rows of
    equal doc_id, stay or go for themselves.  Null and empty texts stay.
    """
    # By place, so that no name can clash.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    id_, text = (F.col(f"c{docs.columns.index(name)}") for name in ("doc_id", "text"))
    keyed = plain.withColumn("key", F.xxhash64(id_, text))
    found = contaminated(keyed.select(F.col("key").alias("doc_id"), text.alias("text")), benchmark, min_words)
    return keyed.join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").drop("key").toDF(*docs.columns)
