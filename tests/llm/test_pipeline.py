from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

import __spark_entry__
import corpus_pipeline
from isoframe.llm import quality
from isoframe.llm.scratch import BATCH, BATCH_ROWS, written
from isoframe.llm.tokens import encoder, vocabulary

from .test_decontaminate import distance
from .test_lines_and_chat import dedup
from .test_neardup import brute as components_of
from .test_quality import brute as signals_of

SF = "/root/testdata/sf0.001"


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now, seen = docs.columns, docs, [texts(docs)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, SF), name.replace(" ", "-"))
        assert now.columns == columns
        seen.append(texts(now))
    raw, good, cut, single, clean = seen
    assert set(good) < set(raw) and all(good[d] == raw[d] for d in good)
    for d in good:
        n, *_, repeated = signals_of(raw[d])
        assert n >= quality.MIN_WORDS and 100 * repeated <= quality.MOST_REPEATED * n
    assert cut == dict(dedup(sorted(good.items())))
    assert single == {d: t for d, t in cut.items() if components_of(list(cut.items()), 5)[d] == d}
    items = [r.text.lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    # Recall of the search is below 1; what it removes is right.
    leaks = {d for d, t in single.items() if any(distance(x, t.lower().split()) <= int(0.2 * len(x)) for x in items if len(x) >= 8)}
    assert set(single) - set(clean) <= leaks and len(leaks & set(clean)) <= 0.03 * len(leaks)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    sizes = {}
    for r in packed:
        ids = encoder(vocabulary()).ids(clean[r.doc_id]) + np.array([0], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)])
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert set(sizes) == set(clean)
    assert [tuple(r) for r in __spark_entry__.queries()["pipeline"](spark, SF).orderBy("doc_id", "piece").select("doc_id", "piece", "length", "ids_crc32").collect()] == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)


def test_stages_take_odd_rows(spark):
    """Nulls, empty and repeated rows, clashing names, and empty tables."""
    some = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) BETWEEN 900 AND 1200").orderBy("doc_id").limit(6).collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").head().text
    rows = [(1, some[0], "a"), (2, some[1], "b"), (2, some[1], "b"), (None, some[2], None), (3, None, "c"), (4, "", "d"), (5, some[0], "e"), (6, some[3] + " " + item, "f"), (None, some[4] + "\n" + item, "g")]
    docs = spark.createDataFrame([(d, t, "en", s, 0, 7, None, 1) for d, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, key long, found_id string, removed int")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, SF), name.replace(" ", "-"))
        assert now.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    # Each stage alone keeps what it can say nothing of.
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stage(spark, docs, SF)
        assert kept.where("doc_id = 3 AND text IS NULL").count() == 1 and kept.where("doc_id IN (4)").count() == 1, name
    single = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, SF)
    assert single.where("doc_id = 5").count() == 0 and single.where("doc_id = 2").count() == 2
    clean = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF)
    assert clean.where("doc_id = 6 OR source = 'g'").count() == 0 and clean.where("doc_id = 2").count() == 2 and clean.where("doc_id IS NULL").count() == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id", "piece", "start").count() >= len(rows)


def test_every_operator_has_a_query():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_texts_go_to_python_in_short_batches(spark, monkeypatch):
    """Whole texts of a stage aren't held by the ten thousand."""
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    rows = spark.range(5000).coalesce(1)
    before = spark.conf.get(BATCH)
    try:
        assert {r.n for r in written(rows.mapInArrow(sizes, "n long"), "sizes").collect()} == {BATCH_ROWS}
        assert spark.conf.get(BATCH) == before
        monkeypatch.setattr(quality, "train", lambda docs, labels: None)
        monkeypatch.setattr(quality, "keep", lambda docs, model: docs)
        corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
        assert int(spark.conf.get(BATCH)) <= BATCH_ROWS
    finally:
        spark.conf.set(BATCH, before)
