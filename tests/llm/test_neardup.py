from __future__ import annotations

import random
import re

import numpy as np
import pytest

from isoframe.llm import neardup
from isoframe.llm.components import components


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def least_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(docs, k):
    sets = [(d, shingles(t, k)) for d, t in docs if d is not None]
    links = [(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[:i] if s and t and 100 * len(s & t) >= 80 * len(s | t)]
    return least_reachable({d for d, _ in sets}, links)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(50)] + [(None, 3), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == least_reachable({x for ab in real for x in ab}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, monkeypatch, k):
    monkeypatch.setattr(neardup, "QUERIES", 4)
    monkeypatch.setattr(neardup, "COMPARED", 8)
    rng = random.Random(k)
    word = lambda: rng.choice(["The", "of", f"w{rng.randrange(900)}"])
    bases = [[word() for _ in range(rng.choice([1, 2, 5, 40, 120]))] for _ in range(30)] + [[word() for _ in range(80)]] * 20
    docs = []
    for i in range(400):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 1 + len(words) // 12)):
            words[rng.randrange(len(words))] = word()
        text = rng.choice([" ", "\n", "\t "]).join(words)
        docs.append((1000 - i, text.upper() if rng.random() < 0.2 else text))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (None, docs[0][1]), (2003, "Été été"), (2004, "été été"), docs[5], (docs[9][0], docs[33][1])]
    frame = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in docs], "doc_id long, text string, doc int, component int, key int")
    rows = neardup.near_duplicates(frame, k).collect()
    want = brute(docs, k)
    assert len(rows) == len(docs)
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.component_id == r.doc_id) for r in rows)
    assert sorted(r.n_shingles for r in rows) == sorted(len(shingles(t, k)) for _, t in docs)
    assert len(set(want.values())) < 330
    assert neardup.near_duplicates(frame.limit(0), k).count() == 0


def test_recall_of_the_tables():
    """Sets of similarity 0.8 share a key nearly always, by the collections' own hashes."""
    rng = np.random.default_rng(8)
    missed = 0
    for _ in range(2000):
        both = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        a, b = both[:85], np.concatenate([both[:80], both[85:]])
        missed += (neardup._collections(a) == neardup._collections(b)).sum() < 2
    assert missed == 0
