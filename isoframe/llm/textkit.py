"""Words, lines and shingles of many texts at once, as numpy arrays.

Texts are UTF-8 bytes laid end to end with a newline after each, so that no
word crosses from one text to the next.  A word is a run of bytes other than
space and 0x09-0x0D.  Word hashes are polynomial sums over the bytes, taken
from one running sum, so the cost is a few array passes whatever the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_BYTE_LOWER = _BYTE[_FOLD]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers, one for each place in a shingle.
_PLACES = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
#: Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 19

_powers = np.ones(1, U64)
_inverses = np.ones(1, U64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << int(n).bit_length()
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, U64(base))
            steps[0] = U64(1)
            both.append(np.multiply.accumulate(steps))
        _powers, _inverses = both
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


def slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE_BYTES together."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > SLICE_BYTES:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


class Texts:
    """Word arrays of a slice of texts.

    ``start`` and ``end`` are byte positions in ``buf``; ``doc`` is the number
    of the text; ``first[i]:first[i + 1]`` are the words of text i.
    """

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.n = len(texts)
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, self.n)
        self.text_end = np.cumsum(lengths + 1) - 1
        self.text_start = self.text_end - lengths
        space = _SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, np.concatenate([self.text_start, [len(self.buf)]]))
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        self._byte = _BYTE_LOWER if lower else _BYTE
        self._sum: np.ndarray | None = None

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans: equal spans have equal hashes."""
        powers, inverses = _tables(len(self.buf) + 1)
        if self._sum is None:
            total = np.empty(len(self.buf) + 1, U64)
            total[0] = 0
            np.cumsum(self._byte[self.buf] * powers[: len(self.buf)], out=total[1:])
            self._sum = total
        return mix((self._sum[end] - self._sum[start]) * inverses[start] + (end - start).astype(U64))

    def words(self) -> np.ndarray:
        """A 64-bit hash for each word."""
        return self.span_hash(self.start, self.end)

    def count_before(self, of_byte: np.ndarray) -> np.ndarray:
        """Running count of the bytes that a 256-entry table selects."""
        return np.concatenate([[0], np.cumsum(of_byte[self.buf])])


def runs(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k words in a row, and where each begins.

    Runs that would cross from one text to the next are left out.
    """
    if len(h) < k:
        return np.empty(0, U64), np.empty(0, np.int64)
    n = len(h) - k + 1
    out = h[:n] * _PLACES[0]
    for j in range(1, k):
        out += h[j : n + j] * _PLACES[j]
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(out[at]), at


def shingle_sets(texts: Texts, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingles of each text.

    A text of fewer than k words has its whole sequence as one; a text
    without words has none.
    """
    h = texts.words()
    hashes, at = runs(h, texts.doc, k)
    cut = np.searchsorted(at, texts.first)
    out = []
    for i in range(texts.n):
        n = texts.first[i + 1] - texts.first[i]
        if n >= k:
            out.append(np.unique(hashes[cut[i] : cut[i + 1]]))
        elif n:
            words = h[texts.first[i] : texts.first[i + 1]]
            out.append(mix((words * _PLACES[k : k + n]).sum(keepdims=True)))
        else:
            out.append(np.empty(0, U64))
    return out


def arrow_slices(column: pa.Array) -> Iterator[tuple[int, int, list[bytes]]]:
    """Ranges of an Arrow column of strings of about SLICE_BYTES, and their bytes.

    The bytes of one range are taken from the column at a time; null is empty.
    """
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    begin = 0
    while begin < len(column):
        end = max(int(np.searchsorted(ends, ends[begin] + SLICE_BYTES, side="right")) - 1, begin + 1)
        end = min(end, len(column))
        at, base = ends[begin : end + 1].tolist(), int(ends[begin])
        raw = data[base : at[-1]].to_pybytes() if data is not None and at[-1] > base else b""
        yield begin, end, [raw[a - base : b - base] for a, b in zip(at, at[1:])]
        begin = end


def encoded(column) -> list[bytes]:
    """UTF-8 bytes of a pandas or Arrow column of strings; null is empty."""
    return [x.encode() if x else b"" for x in column]


def code_points_before(buf: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte position."""
    return np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
