from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from isoframe.llm import decontaminate as d


def distance(item, text):
    """Least edits between the item and any run of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14))
def test_edits_within(item, text):
    a, b = np.array(item, np.uint64), np.array(text, np.uint64)
    edits, start, end = d.edits_within(a, b)
    assert edits == distance(item, text) == plain(item, text[start:end])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.lists(st.integers(0, 3), max_size=14)), max_size=12))
def test_many_pairs_at_once_as_one_by_one(pairs):
    # 0 is what rows are filled up with.
    items, texts = ([np.array(x, np.uint64) for x in some] for some in (zip(*pairs, strict=True) if pairs else ((), ())))
    got = d.edits_of_many(items, texts)
    assert [tuple(r) for r in got.tolist()] == [d.edits_within(a, b) for a, b in zip(items, texts, strict=True)]


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + (kind != 0)] = [] if kind == 1 else [f"new{rng.randrange(10**6)}"]
    return words


def test_recall_and_exactness(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of"] * 400
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [text(n) for n in [3, 8, 9, 14, *(rng.randrange(15, 60) for _ in range(26))]]
    docs, planted = [], 0
    for i in range(400):
        words = text(rng.randrange(0, 200))
        if i % 2:
            item = items[rng.randrange(1, len(items))]
            part = edited(item, rng.randrange(0, int(0.2 * len(item)) + 1), rng)
            at = rng.choice([0, len(words), rng.randrange(len(words) + 1)])
            words[at:at] = part
            planted += 1
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    want = {(i, j) for i, t in docs for j, item in enumerate(items) if len(item) >= d.MIN_WORDS and distance(item, t.lower().split()) <= int(0.2 * len(item))}
    assert len(want) >= planted * 0.95
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(j, " ".join(x).upper()) for j, x in enumerate(items)], "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= want
    assert len(got) >= 0.97 * len(want)
    assert len(found) == len(got)
    text_of = dict(docs)
    for r in found:
        assert plain(items[r.item_id], text_of[r.doc_id].split()[r.start : r.end]) == r.edits


def test_repeated_words(spark):
    items = [(1, "one two three four five six seven eight nine ten"), (2, "go go go go go stop now or go on then")]
    docs = [(1, "go " * 500), (2, "x one two three four five six seven eight nine ten"), (3, "a go go go go go stop now or go on then b"), (4, "one two " * 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for some in (items[:1], items):
        bench = spark.createDataFrame(some, "item_id long, text string")
        assert {(r.doc_id, r.item_id) for r in d.contaminated(frame, bench).collect()} == {(2, 1), (3, 2)} & {(x, i) for x in range(9) for i, _ in some}


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine"
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, item, "x"), (3, item, "x"), (None, item, None), (4, "a " * 50000 + item, "y")], "doc_id long, text string, key string")
    bench = spark.createDataFrame([(7, item, 1), (None, item, 2), (8, None, 3), (9, "", 4), (10, "one two", 5)], "item_id long, text string, start int")
    got = {(r.doc_id, r.item_id, r.start, r.end, r.edits) for r in d.contaminated(docs, bench).collect()}
    # The item of two words is held, too, but no document goes for it.
    assert got == {(x, i, s, s + n, 0) for x, s in ((3, 0), (None, 0), (4, 50000)) for i, n in ((7, 9), (None, 9), (10, 2))}
    assert [r.doc_id for r in d.clean(docs, bench.where("item_id = 10")).where("doc_id = 3").collect()] == [3, 3]
    assert [r.doc_id for r in d.clean(docs, bench).orderBy("doc_id").collect()] == [1, 2]
    assert d.clean(docs, bench).columns == docs.columns
    assert d.contaminated(docs.limit(0), bench).count() == 0
    assert d.contaminated(docs, bench.limit(0)).count() == 0


def test_recall_at_the_edit_limit(spark):
    rng = random.Random(8)
    text = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    kinds = {"substitutions": (2,), "deletions": (1,), "insertions": (0,), "mixed": (0, 1, 2)}
    items, docs, case = [], [], []
    for n in (10, 15, 20, 30, 50, 60, 100, 200):
        for kind, of in kinds.items():
            for _ in range(20):
                item = text(n)
                words = list(item)
                for _ in range(int(0.2 * n)):
                    at, how = rng.randrange(len(words)), rng.choice(of)
                    words[at : at + (how != 0)] = [] if how == 1 else text(1)
                items.append((len(items), " ".join(item)))
                docs.append((len(docs), " ".join(text(20) + words + text(20))))
                case.append((n, kind))
    found = d.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {r.doc_id for r in found if r.doc_id == r.item_id}
    share = {c: sum(case[i] == c for i in got) / 20 for c in set(case)}
    print(share)
    assert min(share.values()) >= 0.9 and len(got) >= 0.97 * len(case)


def test_short_items_are_all_found(spark):
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randrange(60)}" for _ in range(n)]
    items = [text(n) for n in range(1, 8) for _ in range(6)] + [["w1", "w1", "w1", "w1", "w1"], text(20)]
    docs = [text(rng.randrange(0, 60)) for _ in range(250)]
    for k, item in enumerate(items):
        docs.append(text(rng.randrange(9)) + edited(item, int(0.2 * len(item)), rng) + text(rng.randrange(9)))
    found = d.contaminated(spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    want = {(i, j) for i, t in enumerate(docs) for j, item in enumerate(items) if distance(item, t) <= int(0.2 * len(item)) < len(item)}
    assert got <= want and {(i, j) for i, j in want if len(items[j]) < d.WALKED} <= got and len(want) > 300
