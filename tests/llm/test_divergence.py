from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from isoframe.llm import divergence


def brute(rows):
    lower = str.maketrans(divergence.UPPER, divergence.LOWER)
    docs = [(lang or "", source or "", re.findall(divergence.TERM, (text or "").translate(lower))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, words in mine for t in set(words))
        kept = {t for t, n in df.items() if n >= divergence.LEAST_DOCUMENTS}

        def shares(words):
            c = Counter(w for w in words if w in kept)
            return c, {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}

        whole = shares([w for d in mine for w in d[2]])[1]
        groups = {s: shares([w for d in mine if d[1] == s for w in d[2]]) for s in {d[1] for d in mine}}
        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, (c, p) in groups.items():
            pairs = sorted((-sum(f(p[t], q[t]) for t in kept), o.encode()) for o, (_, q) in groups.items() if o != s)
            terms = sorted((-f(p[t], whole[t]), t.encode()) for t in kept if c[t] and p[t] > whole[t])[: divergence.TOP_TERMS]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)]
    return sorted(out)


def table(seed, n=300):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "bé", "c", "Ж", "zz") for b in ("x", "Y", "ab", "ü", "日", "q", "")]
    rows = [(None, None, None), ("en", "", ""), ("en", None, "1 2 3"), ("xx", "a", "rare word"), ("xx", "b", None), ("xx", "b", None), ("one", "only", "c c c " * 3)]
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["s0"] * 6 + ["s1", "s2", "S2", "é", None])
        rows.append((lang, source, " ".join(rng.choices(words, range(1, len(words) + 1), k=rng.randrange(12))) + rng.choice(["", "-a_b", "3d\x00e", " AB,ab"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(divergence, "HELD", 10 if seed == 1 else divergence.HELD)
    rows = table(seed)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    got = divergence.audit(docs.selectExpr("*", "1 AS value", "'x' AS term")).collect()
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got) == brute(rows)
    assert {r.part for r in got} == {"pair", "term"} and ("xx", "a", "pair", "b", 0, 1) in {tuple(r) for r in got}


def test_counts_beyond_billions(spark):
    row = spark.sql("SELECT 5000000000000L AS n, 9000000000000L AS total, 3L AS terms, 0L AS none").select(
        divergence.share(*map(divergence.F.col, ("n", "total", "terms"))), divergence.share(*map(divergence.F.col, ("none", "none", "none"))))
    assert tuple(row.head()) == (1 + 10**9 * (5 * 10**12 + 2) // (9 * 10**12 + 6), None)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
