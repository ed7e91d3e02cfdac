"""Best-fit packing with exact complements (operator 8).

Documents become token ids and an end id.  Longer ones than a sequence are cut
into whole sequences, the rest being the first piece.  How pieces share
sequences depends only on how many there are of each length, and there are at
most ``capacity`` lengths, so the plan is made from that histogram; placing
the pieces by the plan is a Spark job.

The plan first takes combinations that fill a sequence exactly: from the
longest length down, the gap it leaves is looked up in an index of single
lengths, sums of pairs and sums of triples, under the counts still available.
What remains is placed best-fit decreasing.  Each step places as many equal combinations as
the counts allow, so the number of steps depends on ``capacity`` and not on the
number of pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isoframe.llm.scratch import written
from isoframe.llm.textkit import arrow_slices
from isoframe.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
#: Rows that one task ranks, on average, within a length.
RANKED = 1_000_000
#: Groups that each length is dealt into at least.
GROUPS = 64

PIECES = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32.

    ``row`` numbers the input rows, so that repeated rows stay apart.  A null
    text is empty; it holds the end id alone.  A null doc_id stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column("text")):
                out: list[tuple[int, int, int, int, int]] = []  # text, piece, start, length, crc
                for k, text in enumerate(raw):
                    ids = encode.ids(text.decode()) + end
                    n, at, piece = len(ids) // 4, 0, 0
                    while at < n:
                        length = (n - at) % capacity or capacity
                        out.append((k, piece, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)])))
                        at, piece = at + length, piece + 1
                k, piece, start, length, crc = (pa.array(x, pa.int64()) for x in zip(*out, strict=True))
                rows = [batch.column(c).slice(a, b - a).take(k) for c in ("row", "doc_id")]
                yield pa.RecordBatch.from_arrays([*rows, piece.cast(pa.int32()), start, length, crc], ["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(cut, PIECES)


#: Parts in which the exact fills are counted when a share of them is taken.
SHARES = 64


class _Plan:
    """Slots: pieces low..high-1 of a length go to sequences from base on."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.capacity = capacity
        self.sequences = 0
        self.slots: list[tuple[int, int, int, int]] = []  # length, low, base, offset

    def take(self, length: int, times: int, base: int, offset: int) -> None:
        self.slots.append((length, self.used[length], base, offset))
        self.used[length] += times
        self.left[length] -= times

    def fill(self, lengths: list[int]) -> int:
        """Place a combination as often as counts allow."""
        times = min(self.left[x] // lengths.count(x) for x in set(lengths))
        offset = 0
        for x in lengths:
            self.take(x, times, self.sequences, offset)
            offset += x
        self.sequences += times
        return times


class _Sums:
    """Index of the sums of one, two and three available lengths.

    ``longer[s]`` is the longer length of a pair that sums to s, 0 if there is
    none.  Counts only fall, so an entry whose pair is used up moves on to the
    next shorter pair and never back.  A triple is a length and a pair's sum.
    """

    def __init__(self, plan: _Plan):
        self.plan = plan
        self.here = np.zeros(plan.capacity + 1, bool)
        self.here[[x for x, n in plan.left.items() if n]] = True
        self.longer = np.zeros(plan.capacity + 1, np.int64)
        for total in range(2, plan.capacity + 1):
            self._move_on(total, total - 1)

    def used(self, lengths: list[int]) -> None:
        for x in lengths:
            self.here[x] = self.plan.left[x] > 0

    def _pairs(self, total: int, longest: int) -> np.ndarray:
        """Longer lengths of the pairs that sum to a total, from one down."""
        x = np.arange(longest, (total - 1) // 2, -1)
        return x[self.here[x] & self.here[total - x]]

    def _move_on(self, total: int, longest: int) -> None:
        found = self._pairs(total, longest)
        self.longer[total] = found[0] if len(found) else 0

    def _enough(self, lengths: list[int]) -> bool:
        return all(self.plan.left.get(x, 0) >= lengths.count(x) for x in lengths)

    def pair(self, total: int, taken: list[int]) -> list[int]:
        """A pair that sums to a total beside what is taken, the longest first."""
        x = int(self.longer[total])
        if x and not (self.here[x] and self.here[total - x]):
            self._move_on(total, x - 1)
            x = int(self.longer[total])
        if not x:
            return []
        if self._enough([*taken, x, total - x]):
            return [x, total - x]
        rest = ([int(y), total - int(y)] for y in self._pairs(total, x - 1))
        return next((two for two in rest if self._enough([*taken, *two])), [])

    def complement(self, gap: int, taken: list[int]) -> list[int]:
        """One, two or three lengths that sum to a gap, or nothing."""
        if self._enough([*taken, gap]):
            return [gap]
        if gap > 1 and (two := self.pair(gap, taken)):
            return two
        third = np.arange(gap - 2, 0, -1)
        for x in third[self.here[third] & (self.longer[gap - third] > 0)].tolist():
            if self._enough([*taken, x]) and (two := self.pair(gap - x, [*taken, x])):
                return [x, *two]
        return []


def _exact(plan: _Plan) -> list[list[int]]:
    """Consume combinations that fill a sequence, the longest length first.

    Returns them in order.
    """
    sums, fills = _Sums(plan), []
    for length in sorted(plan.left, reverse=True):
        while plan.left[length]:
            gap = plan.capacity - length
            found = [length] + (sums.complement(gap, [length]) if gap else [])
            if sum(found) != plan.capacity:
                break
            plan.fill(found)
            sums.used(found)
            fills.append(found)
    return fills


def _best_fit(plan: _Plan) -> None:
    """Place what is left, longest first, into the smallest gap that holds it.

    Open sequences are kept as runs of equal gap.
    """
    size = plan.capacity
    gaps: list[int] = []  # in order
    open_runs: dict[int, list[tuple[int, int]]] = {}  # gap: (base, sequences)
    for length in sorted((x for x, n in plan.left.items() if n), reverse=True):
        while plan.left[length]:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = size // length
                times = max(plan.left[length] // each, 1)
                each = min(each, plan.left[length])
                base, plan.sequences = plan.sequences, plan.sequences + times
                for k in range(each):
                    plan.take(length, times, base, k * length)
                rest = size - each * length
            else:
                gap = gaps[at]
                base, there = open_runs[gap].pop()
                times = min(there, plan.left[length])
                if times < there:
                    open_runs[gap].append((base + times, there - times))
                if not open_runs[gap]:
                    del open_runs[gap], gaps[at]
                plan.take(length, times, base, size - gap)
                rest = gap - length
            if rest:
                if rest not in open_runs:
                    insort(gaps, rest)
                open_runs.setdefault(rest, []).append((base, times))


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slots (length, low, base, offset) sorted by length and low, and the number of sequences.

    Exact fills first, then best-fit for what is left.  The last fills, of short
    lengths, can leave a worse rest than they save, so best-fit takes over after
    some share of them: of the shares tried, that with the fewest sequences, and
    of equal ones the largest.
    """
    counts = {int(k): int(v) for k, v in counts.items() if v}
    fills = _exact(_Plan(counts, capacity))
    best = None
    tried: dict[int, _Plan] = {}

    def planned(share: int) -> _Plan:
        if share not in tried:
            plan = _Plan(counts, capacity)
            for lengths in fills[: len(fills) * share // SHARES]:
                plan.fill(lengths)
            _best_fit(plan)
            tried[share] = plan
        return tried[share]

    # Coarse shares first, then those around the best one.
    for step in (SHARES // 8, SHARES // 64):
        around = range(SHARES, -1, -step) if best is None else range(min(best + 8 * step, SHARES), max(best - 8 * step, -1), -step)
        best = max(around, key=lambda share: (-planned(share).sequences, share))
    plan = tried[max(tried, key=lambda share: (-tried[share].sequences, share))]
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 4)
    return slots, plan.sequences


def _ranked(placed: DataFrame, total: int) -> DataFrame:
    """Number the pieces of each length from 0.

    Each length is dealt into groups by a hash, so that a length that many
    pieces share isn't numbered by one task; the groups' counts, a few rows a
    length, give where each group's numbers begin.
    """
    groups = max(GROUPS, -(-total // RANKED))
    dealt = placed.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))
    sizes = dealt.groupBy("length", "grp").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("length", "grp", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begins"))
    within = Window.partitionBy("length", "grp").orderBy("row", "piece")
    numbered = dealt.withColumn("within", F.row_number().over(within) - 1)
    return numbered.join(begins, ["length", "grp"]).withColumn("rank", F.col("begins") + F.col("within"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack documents into sequences of at most ``capacity`` tokens.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.  Every input row is packed: null and empty texts as
    their end id, repeated rows each for themselves.  Other columns of
    ``docs`` are not used.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    table = written(pieces(docs, vocabulary, capacity, end_id), "pieces")
    # At most one row for each length from 1 to capacity.
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, _ = plan_slots(counts, capacity)
    # Slots depend on the capacity alone; see the module's docstring.
    shared = spark.sparkContext.broadcast(slots)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = shared.value
        keys = plan[:, 0] << np.int64(44) | plan[:, 1]
        for batch in batches:
            length, rank = batch.length.to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            slot = plan[np.searchsorted(keys, length << np.int64(44) | rank, side="right") - 1].reshape(-1, 4)
            out = batch[["doc_id", "piece", "start", "length", "ids_crc32"]].astype({"doc_id": "Int64"})
            yield out.assign(sequence_id=slot[:, 2] + rank - slot[:, 1], offset=slot[:, 3])

    ranked = _ranked(table, sum(counts.values())).select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
