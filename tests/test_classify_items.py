"""Classes by tables of items are those by pairs of reads and transcripts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from isoframe.functions import intervals
from isoframe.operators import classify
from isoframe.params import Params
from isoframe.plans.queries import QUERIES

SCHEMA = "ord long, gene_id string, tid int, is_rev boolean, exons array<struct<start:int,end:int>>"
SF = "/root/testdata/sf0.001"


def _made(spark, seed: int, n: int, odd: bool):
    """Transcripts of few sites, with many shared ends; odd ones have exons of a base or within others."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        cuts = sorted(rng.sample(range(0, 40), 2 * rng.randint(1, 4)))
        exons = [(x, y) for x, y in zip(cuts[::2], cuts[1::2], strict=True)]
        if odd and rng.random() < 0.2:
            x = rng.randint(0, 40)
            exons = sorted([*exons, (x, x + rng.choice([0, 1, 30]))])
        rows.append((k * 3 + seed, f"g{rng.randint(0, 5)}", rng.randint(0, 1), rng.random() < 0.5, exons))
    out = spark.createDataFrame(rows, SCHEMA)
    return out.withColumn("start", F.col("exons")[0]["start"]).withColumn("end", F.element_at("exons", -1)["end"]).withColumn("cov", F.lit(1))


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("compat", [True, False])
def test_items_say_what_pairs_say(spark, odd, compat):
    params = Params(compat=compat, full_level=3)
    reads, annotation = _made(spark, 1, 400, odd), _made(spark, 2, 120, odd)
    pairs = classify._said_by_pairs(reads, annotation, params)
    items = classify._with_said(reads, annotation, params)
    assert items.count() == 400
    flags = ["known", "has_known_site", *(f"{s}_{k}" for s in ("left", "right") for k in ("1", "2", "any"))]
    values = [F.coalesce(c, F.lit(False)).alias(c) for c in flags] + [F.col("ref")] + [F.array_sort(F.coalesce(f"{x}_hits", F.array())).alias(f"{x}_hits") for x in ("exon", "don", "acc", "joint")]
    whole = reads.select("ord").join(pairs, "ord", "left")
    assert sorted(map(str, items.select("ord", *values).collect())) == sorted(map(str, whole.select("ord", *values).collect()))
    assert items.where("known").count() > 5


def _no_pairs(*_):
    raise AssertionError("pairs of reads and transcripts are formed")


def test_plain_reads_form_no_pairs(spark, monkeypatch):
    """Sizes of 300 reads and as many transcripts of one locus: no join makes a row for each pair."""
    monkeypatch.setattr(classify, "overlapping", _no_pairs)
    assert classify.classified(_made(spark, 1, 300, False), _made(spark, 2, 300, False)).count() == 300


def test_full_gate_classifies_once(spark, monkeypatch):
    calls, plain = [], classify.classified
    monkeypatch.setattr(classify, "classified", lambda *a, **k: calls.append(1) or plain(*a, **k))
    QUERIES["full_gate"](spark, SF)
    assert len(calls) == 1


@pytest.mark.parametrize("name", ["interval_overlap_join", "single_exon_match"])
def test_pairs_are_not_shuffled(spark, monkeypatch, name):
    monkeypatch.setattr(classify, "overlapping", _no_pairs)
    assert QUERIES[name](spark, SF).count() >= 0


def test_single_exons_are_chosen_before_the_join(spark, monkeypatch):
    seen, plain = [], intervals.overlap_join
    monkeypatch.setattr(intervals, "overlap_join", lambda left, right, keys, *a: seen.append((left, right)) or plain(left, right, keys, *a))
    QUERIES["single_exon_match"](spark, SF)
    (left, right), = seen
    assert left.where("size(exons) <> 1").count() == right.where("size(anno) <> 1").count() == 0
