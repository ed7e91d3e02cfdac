from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from isoframe.llm import exact_dedup

SCHEMA = "doc_id long, text string, name string"


def brute(rows):
    groups = defaultdict(list)
    for d, t, *_ in rows:
        groups[t or ""].append(-1 if d is None else d)
    out = []
    for t, ids in groups.items():
        keep, sha = max(ids), hashlib.sha256(t.encode()).hexdigest()
        out += [(d, keep, len(ids), sha) for d in ids]
    return sorted(out)


def plain(rows):
    return sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.keep_id is None else r.keep_id, r.group_size, r.text_sha256) for r in rows)


def rows_with_copies(n=400):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "a ", "A", "é" * 700, "é" * 700 + "e", "x" * exact_dedup.BLOCK, "x" * (exact_dedup.BLOCK + 1), "x" * (exact_dedup.BLOCK * 3)]
    # Texts that differ in one place only: in the first, a middle or the last block.
    long = "".join(rng.choice("abcdef \n") for _ in range(9000))
    texts += [long, "!" + long[1:], long[:4000] + "!" + long[4001:], long[:-1] + "!", long + long]
    rows = [(i, rng.choice(texts), "n") for i in range(n)]
    return rows + [(None, "a", "n"), (None, "only null", "n"), (None, "only null", "m"), (5, "twice", "n"), (5, "twice", "n"), (6, "twice", "n"), (6, "twice", "n")]


@pytest.mark.parametrize("hot", [False, True])
def test_groups_of_equal_texts(spark, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(exact_dedup, "FEW", 3)
        monkeypatch.setattr(exact_dedup, "SHARES", 100)
    monkeypatch.setattr(exact_dedup, "BLOCK", 64)
    rows = rows_with_copies()
    got = exact_dedup.copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert plain(got) == brute(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_rows_that_stay_keep_their_columns(spark):
    rows = rows_with_copies(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = exact_dedup.unique(docs).collect()
    assert exact_dedup.unique(docs).columns == docs.columns
    assert sorted((r.text or "") for r in got) == sorted({t or "" for _, t, _ in rows})
    best = {}
    for d, t, _ in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    assert {(r.text or ""): -1 if r.doc_id is None else r.doc_id for r in got} == best


def test_names_tell_blocks_apart(spark):
    values = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7L, id % 40) AS a", "id % 2 AS b")
    got = exact_dedup.named(values, ["a", "b"]).join(values, "id").groupBy("a", "b").agg({"name": "min", "id": "count"}).collect()
    assert len({r["min(name)"] for r in got}) == len(got)
    assert exact_dedup.named(values, ["a", "b"]).join(values, "id").select("a", "b", "name").distinct().count() == len(got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.copies(docs).count() == 0 and exact_dedup.unique(docs).count() == 0
