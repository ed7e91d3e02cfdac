from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from isoframe.llm import periodic, queries, repeats


def brute_runs(s, least=2, exponent=2):
    """All maximal runs by trying each period, smallest first."""
    n, out = len(s), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, exponent * q) and not any(s[i : i + length - d] == s[i + d : i + length] for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sequences(count, longest, seed):
    rng = random.Random(seed)
    for _ in range(count):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(longest))]
        if len(s) > 4 and rng.random() < 0.5:
            p, b = rng.randrange(1, len(s) // 2 + 1), rng.randrange(len(s))
            s[b:] = [s[b + (i - b) % p] for i in range(b, len(s))]
        yield s
    fib = ["0", "01"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    yield [*map(int, fib[-1])]
    yield [1] * 700


def test_runs_and_vocabulary_equal_brute_force():
    for s in sequences(600, 70, 1):
        start, length, period = repeats.runs(np.array(s, np.int64))
        assert sorted(zip(start.tolist(), length.tolist(), period.tolist()), key=lambda r: (r[0], r[2])) == brute_runs(s)
        if not 0 < len(s) <= 70:
            continue
        tree = repeats.SuffixTree(np.array(s))
        low, _, k = repeats.vocabulary(tree)
        words = {tuple(s[tree.suffixes[a] : tree.suffixes[a] + 2 * q]) for a, q in zip(low, k, strict=True)}
        power = lambda x: any(len(x) % d == 0 and x == x[:d] * (len(x) // d) for d in range(1, len(x)))
        assert len(words) == len(low)
        assert words == {tuple(s[i : i + 2 * q]) for q in range(1, len(s) // 2 + 1) for i in range(len(s) - 2 * q + 1) if s[i : i + q] == s[i + q : i + 2 * q] and not power(s[i : i + q])}


def texts_with_runs(n=150):
    rng = random.Random(5)
    out = [None, "", " \t\n ", "one", "ha " * 23, "ha " * 24, "ha " * 5000, "a b c " * 12, "a  b\tc\n" * 9, "x y " * 11 + "x", "x y " * 11 + "x y"]
    for _ in range(n):
        words = [f"w{rng.randrange(rng.choice([3, 50, 4000]))}" for _ in range(rng.randrange(400))]
        for _ in range(rng.randrange(4)):
            at, p, k = rng.randrange(len(words) + 1), rng.randrange(1, 30), rng.randrange(2, 9)
            unit = [f"w{rng.randrange(60)}" for _ in range(p)]
            words[at:at] = unit * k + unit[: rng.randrange(p)]
        out.append(rng.choice([" ", "\n", "  "]).join(words))
    return out


def brute_text(text, plant=None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if plant is not None and words:
        h = zlib.crc32(str(plant).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
    runs = brute_runs(words, periodic.LEAST, periodic.EXPONENT)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return words, runs, " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("tree", [40, 1 << 17])
def test_runs_of_texts(spark, monkeypatch, tree):
    monkeypatch.setattr(periodic, "TREE_WORDS", tree)
    texts = [t.encode() if t else b"" for t in texts_with_runs()]
    for text, (n, runs, kept) in zip(texts, periodic._slice(texts), strict=True):
        words, expected, collapsed = brute_text(text.decode())
        assert (n, runs, kept.decode()) == (len(words), expected, collapsed)


def test_operator_takes_odd_rows(spark):
    rows = [(None, "ha " * 30, 1), (3, None, 2), (3, None, 2), (4, "a b c d " * 6, 3)]
    got = periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int")).collect()
    assert sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [(0, 30, [(0, 30, 1)], "ha"), (3, 0, [], ""), (3, 0, [], ""), (4, 24, [(0, 24, 4)], "a b c d")]
    assert periodic.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rows = list(enumerate([*texts_with_runs(60), *spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(200).toPandas()["text"]]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d, text in rows:
        _, runs, kept = brute_text(text, d)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        r = got[d]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert r.runs_sha256 == sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)) and r.collapsed_sha256 == sha(kept)
