"""Tandem repeats of sequences in linear passes, and the runs that they form.

After Gusfield and Stoye.  The suffix tree of a sequence stands here as its
suffix array with least common prefixes: a node is an interval of suffixes, a
place on an edge an interval and a length, a suffix link the step from a suffix
to the next.  Every step is taken for many places at once, by numpy.

1. Blocks of the Lempel-Ziv decomposition bound where a tandem repeat can occur
   for the first time.  Extensions around the blocks' ends give, for each length,
   a repeat from which all first occurrences follow by rotation.
2. From each of them, suffix links walk on to its rotations while these are
   repeats, until one has been met: the vocabulary, each repeat once, as an
   interval of suffixes.  Repeats whose half is itself a power are left out:
   their rotations are such, too, and the shorter period has the same run.
3. The suffixes of the intervals are all occurrences.  Those of one period that
   begin next to each other make a run.
"""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Suffix array, common prefixes and names of all blocks of 2^k items.

    ``names[k][i]`` ranks the block of 2^k items from i on among all such, so
    blocks are equal where names are.  Blocks over the end are like no other.
    """

    def __init__(self, items: np.ndarray):
        self.items, self.n = items, len(items)
        rank = np.unique(items, return_inverse=True)[1].astype(np.int64)
        self.names = []
        width = 1
        while True:
            self.names.append(np.append(rank, -1).astype(np.int32))
            if self.n == 0 or int(rank.max()) == self.n - 1:
                break
            next_ = np.zeros(self.n, np.int64)
            if width < self.n:
                next_[:-width] = rank[width:] + 1
            rank = np.unique(rank * (self.n + 1) + next_, return_inverse=True)[1].astype(np.int64)
            width *= 2
        self.rank = rank
        self.suffixes = np.empty(self.n, np.int64)
        self.suffixes[rank] = np.arange(self.n)
        common = np.zeros(self.n, np.int32)
        common[1:] = self.forward(self.suffixes[:-1], self.suffixes[1:])
        # Least common prefixes of 2^k neighbours.
        self.least = [common]
        while 2 << len(self.least) - 1 <= self.n:
            last, step = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(last[:-step], last[step:]))

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal items from a and b on; a and b differ."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names = self.names[k]
            out += (names[np.minimum(a + out, self.n)] == names[np.minimum(b + out, self.n)]).astype(np.int64) << k
        return out

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal items up to and with a and b; a and b differ."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            names, x, y = self.names[k], a - out - (1 << k) + 1, b - out - (1 << k) + 1
            inside = (x >= 0) & (y >= 0)
            out += (inside & (names[np.maximum(x, 0)] == names[np.maximum(y, 0)])).astype(np.int64) << k
        return out

    def below(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last rank of the suffixes that begin like ``start`` does, for a length."""
        low = self.rank[start]
        high = low.copy()
        for k in range(len(self.least) - 1, -1, -1):
            least, step = self.least[k], 1 << k
            at = low - step + 1
            low = np.where((at >= 0) & (least[np.clip(at, 0, len(least) - 1)] >= length), low - step, low)
            at = high + 1
            high = np.where((at < len(least)) & (least[np.clip(at, 0, len(least) - 1)] >= length), high + step, high)
        return low, high

    def child(self, low: np.ndarray, high: np.ndarray, length: np.ndarray, item: np.ndarray) -> np.ndarray:
        """A suffix of each interval that goes on with an item after a length, else -1."""
        end, low, high = high.copy(), low.copy(), high + 1
        # names[0] ranks items; what follows a suffix ascends within an interval.
        after = lambda r: self.names[0][np.minimum(self.suffixes[np.minimum(r, self.n - 1)] + length, self.n)]
        while (low < high).any():
            middle = (low + high) // 2
            less = (low < high) & (after(middle) < item)
            high = np.where((low < high) & ~less, middle, high)
            low = np.where(less, middle + 1, low)
        found = (low <= end) & (after(low) == item)
        return np.where(found, self.suffixes[np.minimum(low, self.n - 1)], -1)


def _counts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0..n-1 for each n one after another, and which n each belongs to."""
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n), owner


def blocks(tree: SuffixTree) -> np.ndarray:
    """Begins of the Lempel-Ziv blocks, and the end of the last.

    A block is the longest stretch that also begins earlier, or one item.
    """
    n = tree.n
    # Neighbours by rank among the suffixes that begin earlier: the later ones
    # are taken out of a chain, last first.
    order = tree.suffixes
    before, after = np.full(n + 1, -1), np.full(n + 1, -1)
    before[order[1:]], after[order[:-1]] = order[:-1], order[1:]
    before, after = before.tolist(), after.tolist()
    for i in range(n - 1, -1, -1):
        a, b = before[i], after[i]
        after[a], before[b] = b, a  # -1 is the spare last place
    i = np.arange(n)
    longest = np.zeros(n, np.int64)
    for other in (before, after):
        other = np.array(other[:n], np.int64)
        longest = np.maximum(longest, np.where(other >= 0, tree.forward(i, np.maximum(other, 0)) if n else 0, 0))
    # Nothing points at a suffix that was taken out, so its neighbours stay.
    steps, begins, at = np.maximum(longest, 1).tolist(), [], 0
    while at < n:
        begins.append(at)
        at += steps[at]
    return np.array([*begins, n], np.int64)


def first_repeats(tree: SuffixTree) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of tandem repeats that cover all first occurrences.

    The first occurrence of each tandem repeat is one of these or follows from
    one by rotations that are repeats, too.
    """
    bounds = blocks(tree)
    begin, end = bounds[:-1], bounds[1:]
    length = end - begin
    # Repeats that begin in the block and end after it: around its end.
    k, b = _counts(length)
    k += 1
    a, c = end[b] - k, end[b]
    ahead, back = tree.forward(a, c), tree.backward(a - 1, c - 1)
    start = np.maximum(a - back, a - k + 1)
    ok = (ahead + back >= k) & (ahead > 0)
    found = [(start[ok], k[ok])]
    # Repeats that begin before the block, their second half in it: around its
    # begin.  The second half reaches no further than the next block.
    k, b = _counts(length + np.append(length[1:], 0) if len(length) else length)
    k += 1
    a, c = begin[b], begin[b] + k
    k, a, c, limit = (x[c < tree.n] for x in (k, a, c, end[b]))
    ahead, back = tree.forward(a, c), tree.backward(a - 1, c - 1)
    start = np.maximum(a - back, a - k + 1)
    ok = (ahead + back >= k) & (ahead > 0) & (back > 0) & (start + k <= limit)
    found.append((start[ok], k[ok]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def vocabulary(tree: SuffixTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rank, last rank and period of each distinct tandem repeat.

    Of those whose half is no power of something shorter.
    """
    start, period = first_repeats(tree)
    ok = _primitive(tree, start, period)
    start, period = start[ok], period[ok]
    known = np.empty(0, np.int64)
    out = []
    while len(start):
        # Where the text itself goes on, so do the suffix links: up to the end
        # of the run or all rotations.
        reach = tree.forward(start, start + period) - period + 1
        steps = np.minimum(reach, period)
        step, of = _counts(steps)
        place, size = start[of] + step, period[of]
        low, high = tree.below(place, 2 * size)
        key, first = np.unique(low * (tree.n + 1) + size, return_index=True)
        new = ~np.isin(key, known)
        first = first[new]
        out.append((low[first], high[first], size[first]))
        fresh = np.zeros(len(start), bool)
        fresh[of[first]] = True
        known = np.union1d(known, key)
        # Where it doesn't, the next rotation may occur elsewhere: the suffix
        # link of the last repeat's place, then the branch for its first item.
        ends = fresh & (reach < period)
        last, size = (start + reach - 1)[ends], period[ends]
        last, size = np.unique(np.stack([last, size]), axis=1) if len(last) else (last, size)
        low, high = tree.below(last + 1, 2 * size - 1)
        other = tree.child(low, high, 2 * size - 1, tree.names[0][last])
        start, period = other[other >= 0], size[other >= 0]
        low, _ = tree.below(start, 2 * period)
        unknown = ~np.isin(low * (tree.n + 1) + period, known)
        start, period = start[unknown], period[unknown]
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _primitive(tree: SuffixTree, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether no shorter period divides that of a tandem repeat."""
    ok = np.ones(len(start), bool)
    rest, prime = period.copy(), 2
    while len(rest) and rest.max() > 1:
        if prime * prime > rest.max():
            # What is left of each is a prime or 1.
            divisors = rest
        else:
            divisors = np.where(rest % prime == 0, prime, 1)
            while (again := (rest % prime == 0)).any():
                rest = np.where(again, rest // prime, rest)
            prime += 1
        test = np.flatnonzero((divisors > 1) & ok)
        shorter = period[test] // divisors[test]
        ok[test] = tree.forward(start[test], start[test] + shorter) < 2 * period[test] - shorter
        if divisors is rest:
            break
    return ok


def runs(items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the maximal runs of two periods or more.

    The period is the smallest; by period, then start.
    """
    tree = SuffixTree(np.asarray(items))
    low, high, period = vocabulary(tree)
    step, of = _counts(high - low + 1)
    start, period = tree.suffixes[low[of] + step], period[of]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    head = np.ones(len(start), bool)
    head[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(start)) - 1 if len(at) else at
    return start[at], start[last] + 2 * period[at] - start[at], period[at]
