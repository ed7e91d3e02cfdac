from __future__ import annotations

import hashlib
import random
import time
import zlib
from collections import Counter as Tally

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isoframe.llm import packing, token_counts, token_output, tokens
from isoframe.llm.scratch import new_path
from isoframe.llm.tokens import encoder, vocabulary

LIBRARY = Tokenizer.from_file(vocabulary())
PLAIN = Tokenizer.from_file(vocabulary())
PLAIN.encode_special_tokens = True
TEXTS = ["", " ", "a", "  a  b ", "a\n \nb", "it's we'll  \t x  y", "x<|endoftext|>y", "éü 漢字 🙂 ok", "word " * 3000, "z" * 5000, "\n\n", "tab\t \t end "]
SCHEMA = "doc_id long, text string, row long, extra int, length string"


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def plain_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\t\r  \x1c\x85ab'sZé漢1٣!?.🙂")), max_size=60))
def test_ids_are_the_librarys(text):
    assert np.frombuffer(encoder(vocabulary()).ids(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("text", TEXTS)
def test_ids_of_odd_texts(text):
    assert np.frombuffer(encoder(vocabulary()).ids(text), "<u4").tolist() == ids(text)


def test_marked_words_need_neither_the_pattern_nor_another_copy(monkeypatch):
    """A word is remembered once, however it is written, and later marked ones not at all."""
    monkeypatch.setattr(tokens, "REMEMBER_MARKED", 0)
    encode = tokens.Encoder(vocabulary())
    asked = []
    monkeypatch.setattr(encode, "split", lambda text: asked.append(text) or [])
    text = " stone, stone stone!! Größe; Größe...\nStone, <stone> a_b\nstone"
    got = np.frombuffer(encode.ids(text), "<u4").tolist()
    assert asked == [" <stone>", " a_b", ""]
    monkeypatch.undo()
    assert np.frombuffer(tokens.Encoder(vocabulary()).ids(text), "<u4").tolist() == ids(text)
    assert sorted(encode._words) == sorted({"stone", "Größe", "a_b", "\nstone"}) and len(got) < len(ids(text))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "\n", "'", "("]), st.sampled_from(["word", "Größe", "Ā", "ɐb", "it's", "é", "1", "a1", ""]), st.text(alphabet=st.sampled_from(list("!?.,_~'|<>$^`£´")), max_size=3)), max_size=8))
def test_ids_of_marked_words(words):
    text = " ".join(map("".join, words))
    assert np.frombuffer(encoder(vocabulary()).ids(text), "<u4").tolist() == ids(text)


def test_pretokens_are_the_librarys():
    """The pattern used for counting splits as the vocabulary's own rule does."""
    split = token_counts.counter(vocabulary()).split
    for low in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}b {chr(c)}" for c in range(low, low + 64) if not 0xD800 <= c < 0xE000)
        theirs = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert split(text) == theirs, hex(low)


def sound(node):
    """Sums are those below, and heights differ by one at most."""
    if node is None or node.left is None:
        return True
    a, b = node.left, node.right
    sums = (a.size + b.size, a.chars + b.chars, a.tokens + b.tokens)
    return abs(a.height - b.height) <= 1 and node.height == max(a.height, b.height) + 1 and sums == (node.size, node.chars, node.tokens) and sound(a) and sound(b)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list(" \n\tab'sé1!.")), max_size=40), st.lists(st.tuples(st.integers(-2, 45), st.integers(-2, 45), st.text(alphabet=st.sampled_from(list(" \nab's1!")), max_size=6)), max_size=5), st.sampled_from([2, 3, 64]))
def test_edited_counts_match_full_encoding(text, edits, leaf):
    token_counts.LEAF, old = leaf, token_counts.LEAF
    try:
        kept = token_counts.CountedText(text, token_counts.counter(vocabulary()))
        assert kept.n_tokens == len(plain_ids(text))
        for e in edits:
            kept.edit(*e)
            assert kept.n_tokens == len(plain_ids(kept.text))
            assert kept.n_chars == len(kept.text) and kept.n_pretokens == len(kept.by.split(kept.text))
            assert sound(kept.root)
    finally:
        token_counts.LEAF = old


def test_edit_touches_its_region_only():
    kept = token_counts.CountedText("some words here " * 5000, token_counts.counter(vocabulary()))
    kept.edit(40000, 40003, "new text")
    assert kept.reencoded < 12
    assert kept.n_tokens == len(plain_ids(kept.text))


def test_an_edit_visits_a_logarithm_of_the_nodes():
    by, rng = token_counts.counter(vocabulary()), random.Random(3)
    visited = []
    for n in (10_000, 1_000_000):
        kept = token_counts.CountedText("word or two " * (n // 3), by)
        for _ in range(200):
            at = rng.randrange(kept.n_chars)
            kept.edit(at, at + rng.randrange(20), rng.choice(["", " and", "x\n"]))
        assert sound(kept.root) and kept.root.height < 1.45 * np.log2(kept.n_pretokens)
        blocks = list(map(len, kept._blocks(kept.root)))
        assert max(blocks) <= token_counts.LEAF and np.mean(blocks) > token_counts.LEAF / 3
        visited.append(kept.visited / 200)
    assert kept.n_tokens == len(plain_ids(kept.text))
    # A hundred times the text, twice the path and a little more.
    assert visited[1] < 2.5 * visited[0] and visited[1] < 150


def test_edited_counts_query(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "a b"), (99, None)]
    out = token_counts.edited_counts(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary()).collect()
    assert len(out) == len(rows)
    want = {}
    for doc_id, text in rows:
        text = text or ""
        before = len(plain_ids(text))
        for a, b, new in token_counts.sample_edits(doc_id, len(text)):
            b = min(max(b, a), len(text))
            text = text[:a] + new + text[b:]
        want[doc_id] = (before, len(plain_ids(text)))
    assert {r.doc_id: (r.n_tokens, r.n_tokens_after) for r in out} == want
    own = spark.createDataFrame([(1, "a b c", [(0, 1, "xy"), (None, None, None)]), (2, "a", None)], "doc_id long, text string, changes array<struct<start:int,end:int,new:string>>")
    got = {r.doc_id: r for r in token_counts.edited_counts(own, vocabulary(), "changes").collect()}
    assert got[1].n_tokens_after == len(plain_ids("xy b c")) and got[1].n_edits == 2 and got[2].n_edits == 0
    assert token_counts.edited_counts(spark.createDataFrame([], "doc_id long, text string"), vocabulary()).count() == 0


def documents(spark):
    rows = [(i, t, 7, None, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, 1, None), (None, "a b", 1, 1, None), (99, None, None, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("capacity", [2048, 16, 1])
def test_packing(spark, capacity):
    rows, docs = documents(spark)
    out = packing.pack(docs, vocabulary(), capacity).collect()
    whole = Tally()
    for doc_id, text, *_ in rows:
        all_ids, at, piece = [*ids(text), 0], 0, 0
        while at < len(all_ids):
            n = (len(all_ids) - at) % capacity or capacity
            whole[doc_id, piece, at, n, zlib.crc32(np.array(all_ids[at : at + n], "<u4").tobytes())] += 1
            at, piece = at + n, piece + 1
    assert whole == Tally((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack(docs.limit(0), vocabulary(), capacity).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40), max_size=12))
def test_plan_is_whole_and_near_the_least(counts):
    slots, sequences = packing.plan_slots(counts, 24)
    total = sum(k * v for k, v in counts.items())
    # Plain best-fit decreasing, piece by piece.
    gaps = []
    for x in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((24 if fit is None else fit) - x)
    assert -(-total // 24) <= sequences <= len(gaps)
    used = Tally()
    for length, low, _, _ in slots.tolist():
        assert low == used[length] or low <= counts[length]
        used[length] += 1


def brute_complement(left, gap, most=3):
    """Whether up to three available lengths sum to a gap."""
    if gap == 0:
        return True
    return most > 0 and any(n and brute_complement({**left, x: n - 1}, gap - x, most - 1) for x, n in left.items() if x <= gap)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 23), st.integers(1, 3), min_size=1, max_size=7))
def test_no_exact_combination_is_left(counts):
    plan = packing._Plan(counts, 24)
    packing._exact(plan)
    for length, n in plan.left.items():
        assert not n or not brute_complement({**plan.left, length: n - 1}, 24 - length)


@pytest.mark.parametrize("kind", ["lognormal", "uniform", "exponential", "narrow"])
def test_exact_fills_stay_and_cost_no_sequence(kind):
    rng = np.random.default_rng(7)
    for n in (300, 3000, 20000):
        x = {"lognormal": rng.lognormal(5.5, 1.2, n), "uniform": rng.uniform(1, 2048, n), "exponential": rng.exponential(400, n), "narrow": rng.normal(700, 80, n)}[kind]
        lengths, counts = np.unique(np.clip(x.astype(int), 1, 2048), return_counts=True)
        counts = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        slots, sequences = packing.plan_slots(counts)
        plain = packing._Plan(counts, packing.CAPACITY)
        packing._best_fit(plain)
        assert sequences <= plain.sequences
        exact = packing._Plan(counts, packing.CAPACITY)
        if len(packing._exact(exact)) > 50:
            # Sequences that the plan fills to the last token.
            used = np.zeros(sequences, np.int64)
            bounds = {x: sorted([s[1] for s in slots if s[0] == x] + [counts[x]]) for x in counts}
            for length, low, base, _ in slots.tolist():
                high = next(b for b in bounds[length] if b > low)
                used[base : base + high - low] += length
            assert (used <= packing.CAPACITY).all() and (used == packing.CAPACITY).sum() >= exact.sequences / 2


def test_plan_of_all_lengths_is_quick():
    rng = np.random.default_rng(4)
    for counts in ({x: int(n) for x, n in zip(range(1, 2049), rng.integers(1, 5000, 2048))}, {x: 1 for x in range(1, 2049)}, {x: 1 + x % 3 for x in range(900, 2049)}):
        began = time.process_time()
        slots, sequences = packing.plan_slots(counts)
        assert time.process_time() - began < 2
        placed = Tally()
        for (length, low, _, _), after in zip(slots.tolist(), [*slots.tolist()[1:], [0, 0, 0, 0]]):
            placed[length] += (after[1] if after[0] == length else counts[length]) - low
        assert placed == counts and sequences >= sum(k * v for k, v in counts.items()) / 2048


def test_token_output_round_trip(spark):
    rows, docs = documents(spark)
    path = new_path(spark, "ids")
    token_output.write_tokens(docs, path, vocabulary())
    out = token_output.read_tokens(spark, path).collect()
    start, want = 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        all_ids = [*ids(text), 2]
        want.append((doc_id, start, len(all_ids), zlib.crc32(np.array(all_ids, "<u4").tobytes())))
        start += len(all_ids)
    assert sorted(want, key=lambda r: r[1]) == sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out), key=lambda r: r[1])
    assert token_output.read_document(spark, path, 7).tolist() == [*ids(TEXTS[7]), 2]
    assert token_output.read_document(spark, path, 12345) is None
    empty = new_path(spark, "ids")
    token_output.write_tokens(docs.limit(0), empty, vocabulary())
    assert token_output.read_tokens(spark, empty).count() == 0


def test_token_output_uses_the_dictionary(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "concat('the number of this text is ', id % 50, ' and its square is ', id * id) as text")
    path = new_path(spark, "ids")
    token_output.write_tokens(docs, path, vocabulary())
    row = spark.read.parquet(f"{path}/dictionary").head()
    assert len(row.dictionary) > 0 and hashlib.sha256(row.dictionary).hexdigest() == row.dictionary_sha256
    assert {r[0] for r in spark.read.parquet(f"{path}/blocks").select("dictionary_sha256").collect()} == {row.dictionary_sha256}
    assert token_output.read_tokens(spark, path).count() == 400
