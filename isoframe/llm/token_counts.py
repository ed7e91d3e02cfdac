"""Token counts that follow edits (operator 7).

A document's pre-tokens are the leaves of a balanced segment tree, in blocks of
up to LEAF of them; each node holds the sums of pre-tokens, characters and
tokens below it.  An edit takes out the blocks that it touches, re-encodes from
a little before it until an old boundary and a new one meet again, puts the
blocks back and updates the sums on the paths to them, so that its cost grows
with the logarithm of the text's length.  The text itself lives in the leaves.
Strings of special tokens count as ordinary text, since an edit can make or
break them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.llm.textkit import arrow_slices
from isoframe.llm.tokens import encoder

#: Pre-tokens of a block at most.
LEAF = 64
#: Pre-tokens whose counts a Python worker remembers.
REMEMBER = 250_000
#: Characters after its end on which a pre-token may depend.
AHEAD = 2

COUNTS = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_pretokens_after long, n_reencoded long"


class Counter(dict):
    """Token counts of pre-tokens, remembered."""

    def __init__(self, vocabulary: str):
        super().__init__()
        self.encode = encoder(vocabulary)
        self.split, self.view, self.find = self.encode.split, self.encode.view, self.encode.find

    def __missing__(self, piece: str) -> int:
        n = len(self.encode.of_pretoken(piece)) // 4
        if len(self) < REMEMBER:
            self[piece] = n
        return n


@lru_cache(maxsize=4)
def counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


class Node:
    """A block of pre-tokens, or two subtrees, with the sums over it."""

    __slots__ = ("chars", "height", "left", "pieces", "right", "size", "tokens")

    def __init__(self, left: Node | None, right: Node | None, pieces: list[str], sums: tuple[int, int, int], height: int):
        self.left, self.right, self.pieces, self.height = left, right, pieces, height
        self.size, self.chars, self.tokens = sums


class CountedText:
    """A text whose token count is kept under edits.

    ``visited`` counts the nodes made or passed by edits, ``reencoded`` the
    pre-tokens that they encoded.
    """

    def __init__(self, text: str, by: Counter):
        self.by = by
        self.visited = self.reencoded = 0
        self.root = self._built(by.split(text))
        self.visited = 0

    @property
    def text(self) -> str:
        """The whole text; an edit doesn't need it."""
        return "".join(p for block in self._blocks(self.root) for p in block)

    @property
    def n_chars(self) -> int:
        return self.root.chars if self.root else 0

    @property
    def n_tokens(self) -> int:
        return self.root.tokens if self.root else 0

    @property
    def n_pretokens(self) -> int:
        return self.root.size if self.root else 0

    def _blocks(self, node: Node | None) -> Iterator[list[str]]:
        if node is None:
            return
        if node.left is None:
            yield node.pieces
        else:
            yield from self._blocks(node.left)
            yield from self._blocks(node.right)

    def _both(self, left: Node, right: Node) -> Node:
        self.visited += 1
        return Node(left, right, [], (left.size + right.size, left.chars + right.chars, left.tokens + right.tokens), max(left.height, right.height) + 1)

    def _built(self, pieces: list[str]) -> Node | None:
        """A tree of blocks of about the same size."""
        n = -(-len(pieces) // LEAF)
        level = []
        for i in range(n):
            block = pieces[i * len(pieces) // n : (i + 1) * len(pieces) // n]
            level.append(Node(None, None, block, (len(block), sum(map(len, block)), sum(map(self.by.__getitem__, block))), 0))
        self.visited += n
        while len(level) > 1:
            pairs = [self._both(a, b) for a, b in zip(level[0::2], level[1::2])]
            if len(level) % 2:
                pairs[-1] = self._joined(pairs[-1], level[-1])
            level = pairs
        return level[0] if level else None

    def _balanced(self, left: Node, right: Node) -> Node:
        """Two trees whose heights differ by two at most, as one."""
        if right.height > left.height + 1:
            inner, outer = right.left, right.right
            if inner.height > outer.height:
                return self._both(self._both(left, inner.left), self._both(inner.right, outer))
            return self._both(self._both(left, inner), outer)
        if left.height > right.height + 1:
            outer, inner = left.left, left.right
            if inner.height > outer.height:
                return self._both(self._both(outer, inner.left), self._both(inner.right, right))
            return self._both(outer, self._both(inner, right))
        return self._both(left, right)

    def _joined(self, left: Node | None, right: Node | None) -> Node | None:
        """One tree after another."""
        if left is None or right is None:
            return left or right
        if left.height > right.height + 1:
            return self._balanced(left.left, self._joined(left.right, right))
        if right.height > left.height + 1:
            return self._balanced(self._joined(left, right.left), right.right)
        return self._both(left, right)

    def _parted(self, node: Node | None, chars: int) -> tuple[Node | None, Node | None]:
        """The blocks that end within the first ``chars`` characters, and the rest."""
        if node is None:
            return None, None
        self.visited += 1
        if node.left is None:
            return (node, None) if node.chars <= chars else (None, node)
        if chars < node.left.chars:
            before, after = self._parted(node.left, chars)
            return before, self._joined(after, node.right)
        before, after = self._parted(node.right, chars - node.left.chars)
        return self._joined(node.left, before), after

    def _first(self, node: Node) -> tuple[list[str], Node | None]:
        """The first block, and the tree without it."""
        self.visited += 1
        if node.left is None:
            return node.pieces, None
        pieces, left = self._first(node.left)
        return pieces, self._joined(left, node.right)

    def _last(self, node: Node) -> tuple[Node | None, list[str]]:
        self.visited += 1
        if node.left is None:
            return None, node.pieces
        right, pieces = self._last(node.right)
        return self._joined(node.left, right), pieces

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters start..end-1 by ``new``."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(end, start), self.n_chars)
        shift = len(new) - (end - start)
        # Pre-tokens that end more than AHEAD before the edit stand.
        left, rest = self._parted(self.root, start - AHEAD - 1)
        at = left.chars if left else 0
        start, end = start - at, end - at
        old: list[str] = []  # the pre-tokens taken out, and their end
        taken = 0
        while rest is not None and taken <= end + AHEAD:
            block, rest = self._first(rest)
            old += block
            taken += sum(map(len, block))
        pieces, kept = [], 0
        for p in old:
            if kept + len(p) + AHEAD >= start:
                break
            pieces.append(p)
            kept += len(p)
        bounds, here = {}, 0
        for i, p in enumerate(old):
            bounds[here], here = i, here + len(p)
        was = "".join(old)
        buffer = was[:start] + new + was[end:]
        view, here = self.by.view(buffer), kept
        while True:
            if here >= start + len(new) and here - shift in bounds:
                pieces += old[bounds[here - shift] :]
                break
            stop = self.by.find.match(view, here).end() if here < len(buffer) else here
            if rest is not None and stop + AHEAD >= len(buffer):
                # The pre-token may go on in the text not taken out yet.
                more, size = [], 0
                while rest is not None and size < len(buffer):
                    block, rest = self._first(rest)
                    for p in block:
                        bounds[taken], taken, size = len(old) + len(more), taken + len(p), size + len(p)
                        more.append(p)
                old += more
                buffer += "".join(more)
                view = self.by.view(buffer)
                continue
            if stop == here:
                break
            pieces.append(buffer[here:stop])
            self.reencoded += 1
            here = stop
        # Blocks stay at least half full, but for a text that is one block.
        if len(pieces) < LEAF // 2 and rest is not None:
            block, rest = self._first(rest)
            pieces = pieces + block
        elif len(pieces) < LEAF // 2 and left is not None:
            left, block = self._last(left)
            pieces = block + pieces
        self.root = self._joined(self._joined(left, self._built(pieces)), rest)


def sample_edits(doc_id: int | None, n: int) -> list[tuple[int, int, str]]:
    """Edits that the query applies: an insertion, a replacement, a deletion.

    Their places follow from the text's ``n`` characters and the doc_id alone.
    """
    key = (doc_id or 0) * 2654435761 % 1000003
    return [
        (n * (key % 97) // 97, n * (key % 97) // 97, f" revised {key}"),
        (n // 3, n // 3 + key % 29, "\n"),
        (n // 2, n // 2 + key % 41, ""),
    ]


def _whole_edit(e: Column) -> Column:
    return F.struct(*(F.coalesce(e[name], F.lit(none)).alias(name) for name, none in (("start", 0), ("end", 0), ("new", ""))))


def edited_counts(docs: DataFrame, vocabulary: str, edits: str | None = None) -> DataFrame:
    """Token counts of each text before and after its edits.

    ``edits`` names a column array<struct<start, end, new>> of edits, applied
    one after another; without it those of ``sample_edits`` are made.  Returns
    doc_id, n_tokens, n_edits, n_tokens_after, n_pretokens_after, n_reencoded
    for each input row.  A null text is empty; null edits are none; places
    past the end are moved to the end.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = counter(vocabulary)
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column("text")):
                out, doc_ids = [], batch.column("doc_id").slice(a, b - a)
                own = batch.column("edits").slice(a, b - a).to_pylist()
                for doc_id, text, edits_of in zip(doc_ids.to_pylist(), raw, own, strict=True):
                    kept = CountedText(text.decode(), by)
                    before = kept.n_tokens
                    todo: Sequence = sample_edits(doc_id, kept.n_chars) if edits is None else [(e["start"], e["end"], e["new"]) for e in edits_of]
                    for edit in todo:
                        kept.edit(*edit)
                    out.append((before, len(todo), kept.n_tokens, kept.n_pretokens, kept.reencoded))
                yield pa.RecordBatch.from_arrays([doc_ids, *(pa.array(x, pa.int64()) for x in zip(*out, strict=True))], [c.split()[0] for c in COUNTS.split(", ")])

    own = F.lit(None).cast("string") if edits is None else F.coalesce(F.transform(edits, _whole_edit), F.array())
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), own.alias("edits"))
    return plain.mapInArrow(counted, COUNTS)
