"""Periodic runs of words in documents (operator 13).

A run is a stretch of words that repeats with a period of q words, its smallest,
at least EXPONENT times and over LEAST words, and that no neighbouring word
extends.  Runs are found by ``repeats``, document by document.

Of such a run each stretch of SEED words occurs again, one period later or
earlier, within the run.  So runs lie within stretches of words all of whose
SEED-grams occur again in the document, and only these stretches go through the
suffix tree: most documents have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isoframe.llm import repeats
from isoframe.llm.textkit import Texts, arrow_slices, mix
from isoframe.llm.textkit import runs as grams

LEAST, EXPONENT = 24, 3
#: Words of a seed.  A run of n words and period q has n >= LEAST and n >= 3q, so
#: n - 2q >= 8: the seeds that recur later and those that recur earlier cover it.
SEED = LEAST // EXPONENT
#: Words of stretches that go through one suffix tree; a longer stretch goes alone.
TREE_WORDS = 1 << 17

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def repeated_stretches(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of words covered by recurring seeds.

    Numbers of words in the slice; equal hashes of other words only add some.
    """
    seeds, at = grams(texts.words(), texts.doc, SEED)
    if not len(seeds):
        return at, at
    of_doc = mix(seeds + texts.doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, counts = np.unique(of_doc, return_inverse=True, return_counts=True)
    at = at[counts[which] > 1]
    # Seeds that touch or overlap, of one document, make a stretch.
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] > at[:-1] + 1) | (texts.doc[at[1:]] != texts.doc[at[:-1]])
    begin = at[new]
    end = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1] + SEED if len(at) else at
    # A run's seeds are all there, so what is shorter holds none.
    long = end - begin >= LEAST
    return begin[long], end[long]


def _batches(begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of stretches of about TREE_WORDS together."""
    first, size = 0, 0
    for i, n in enumerate((end - begin).tolist()):
        if size and size + n > TREE_WORDS:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(begin):
        yield first, len(begin)


def found(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (word of the slice), length, period of the runs of all texts."""
    begin, end = repeated_stretches(texts)
    raw, out = texts.buf.tobytes(), []
    for i, j in _batches(begin, end):
        n = end[i:j] - begin[i:j]
        # Stretches one after another, each led by an item of its own, so that
        # nothing repeats across them.
        place = np.cumsum(n + 1) - n
        word = np.repeat(begin[i:j] - place, n + 1) + np.arange(int((n + 1).sum()))
        inside = np.ones(len(word), bool)
        inside[place - 1] = False
        numbers: dict[bytes, int] = {}
        spans = zip(texts.start[word[inside]].tolist(), texts.end[word[inside]].tolist(), strict=True)
        items = np.empty(len(word), np.int64)
        items[inside] = [numbers.setdefault(raw[a:b], len(numbers)) for a, b in spans]
        items[~inside] = -1 - np.arange(j - i)
        start, length, period = repeats.runs(items)
        ok = (length >= LEAST) & (length >= EXPONENT * period)
        out.append((word[start[ok]], length[ok], period[ok]))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _slice(raw: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs and the text without repetitions, for each text."""
    texts = Texts(raw)
    start, length, period = found(texts)
    doc = texts.doc[start]
    order = np.lexsort((period, start, doc))
    rows = zip(start[order].tolist(), length[order].tolist(), period[order].tolist(), strict=True)
    of_doc: dict[int, list[tuple[int, int, int]]] = {}
    for d, (a, n, q) in zip(doc[order].tolist(), rows, strict=True):
        of_doc.setdefault(d, []).append((a - int(texts.first[d]), n, q))
    for d, text in enumerate(raw):
        # White space of bytes is what parts words.
        words, mine = text.split(), of_doc.get(d, [])
        kept = np.ones(len(words), bool)
        for a, n, q in mine:
            kept[a + q : a + n] = False
        yield len(words), mine, b" ".join([words[i] for i in np.flatnonzero(kept).tolist()] if mine else words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, collapsed for each row of ``docs``.

    ``runs`` has start (number of its first word, from 0), length and period in
    words, by start, then period.  ``collapsed`` is the text's words but those of a run
    beyond its first period, one space between; words that several runs drop
    are dropped once.  A null or empty text has no words, no runs and an empty
    string.  Rows are taken each for itself, so repeated rows and null doc_ids
    come out as they came; other columns are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for begin, end, raw in arrow_slices(batch.column(1)):
                n, runs, kept = zip(*_slice(raw), strict=True)
                flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run))
                columns = [batch.column(0).slice(begin, end - begin), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    plain = docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "CAST(text AS STRING) AS text")
    return plain.mapInArrow(rows, SCHEMA)
