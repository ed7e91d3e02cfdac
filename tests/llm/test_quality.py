from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isoframe.llm import quality
from isoframe.llm.textkit import Texts, encoded

SF = "/root/testdata/sf0.1"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab é\n\t#|漢")), max_size=60), min_size=1, max_size=5))
def test_signals(texts):
    assert [tuple(r) for r in quality.signals(Texts(encoded(texts))).itertuples(index=False)] == [brute(t) for t in texts]


def test_odd_rows(spark):
    texts = [None, "", " \n ", "a", "b " * 49, "a b c " * 40, " ".join(map(str, range(60))), "x" * 300000, "é\n" * 9]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "a", 2), (3, "a", 2)], "doc_id long, text string, kept int")
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    out = quality.scored(docs, model).collect()
    assert len(out) == 11
    by = {r.doc_id: r for r in out if r.doc_id != 3}
    for i, t in enumerate(texts):
        if i != 3:
            n, *_, repeated = want = brute(t)
            assert tuple(by[i][c] for c in quality.SIGNALS) == want
            assert by[i].base_failed == (n < 50 or 100 * repeated > 50 * n)
            assert by[i].kept == (not by[i].base_failed)
    assert quality.keep(docs, model).columns == docs.columns
    assert [r.doc_id for r in quality.keep(docs, model).collect()] == [6]
    assert quality.scored(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    even = labels.where("doc_id % 2 = 0")
    return docs, labels.where("doc_id % 2 = 1"), quality.train(docs, even.unionByName(even.limit(5)))


def test_held_out_accuracy(fitted):
    docs, held, model = fitted
    rows = quality.scored(docs, model).join(held, "doc_id").select("probability", "quality").collect()
    p, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert ((p >= quality.KEEP_AT) == (y > 0)).mean() > 0.93
    assert (p[y > 0] >= quality.KEEP_AT).mean() > 0.97
    # Calibrated: the mean probability is near the share of good rows.
    assert abs(p.mean() - (y > 0).mean()) < 0.06


def test_margins_are_the_features_weighted(fitted):
    _, _, model = fitted
    strings = ["one two three", "", "été à la", "a"]
    texts = Texts(encoded(strings))
    want = [model.bias + model.weights[i] @ v for i, v in quality._features(texts)]
    assert np.allclose(model.margins(texts), want)


def test_toxic_documents_are_rejected(fitted):
    docs, held, model = fitted
    rows = quality.scored(docs, model).join(held, "doc_id").select("doc_id", "kept", "toxic", "quality", "base_failed", "toxicity").collect()
    long = [r for r in rows if not r.base_failed]
    share = lambda rows: sum(r.kept for r in rows) / len(rows)
    assert share([r for r in long if r.toxic]) < 0.3
    assert share([r for r in long if not r.toxic and r.quality]) > 0.97
    assert {r.doc_id for r in quality.keep(docs, model).join(held, "doc_id").collect()} == {r.doc_id for r in rows if r.kept}


def test_presence_counts_once(fitted):
    toxic = fitted[2].toxic
    strings = ["stupid idiot, what a clown", "", "stupid " * 9, "é", "the pathetic scum"]
    texts = Texts(encoded(strings))
    want = [toxic.bias + toxic.weights[i].sum() for i, _ in quality._features(texts)]
    assert np.allclose(toxic.margins(texts), want)
