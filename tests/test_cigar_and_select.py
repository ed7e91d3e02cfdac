from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoframe.functions import cigar, intervals
from isoframe.operators import junctions, select
from isoframe.operators.transcripts import from_alignments, strand
from isoframe.params import Params

ALN = "ord long, qname string, flag int, tid int, pos int, cigar string, l_qseq int, nm int, nh int, xs string"


def walk(text, start, min_exon=3, min_intron=3, max_deletion=50):
    out, s, e = [], start, start - 1
    for n, op in re.findall("([0-9]+)([MIDNSHPX=])", text):
        n = int(n)
        if (op == "N" and n >= min_intron) or (op == "D" and n > max_deletion):
            if not out or e - s + 1 >= min_exon:
                out.append((s, e))
            s = e + n + 1
        e += n if op in "MDN=X" else 0
    return [*out, (s, e)]


def test_golden_exons(spark):
    row = spark.range(1).select(cigar.exons(cigar.ops(F.lit("5S10M100N2M50N20M60D8M2I3S")), F.lit(1000), 3, 3, 50).alias("x")).head()
    assert [tuple(x) for x in row.x] == [(1000, 1009), (1162, 1181), (1242, 1249)]


def test_random_cigars(spark):
    rng = random.Random(1)
    texts = ["".join(f"{rng.choice([1, 2, 3, 30, 51, 200])}{rng.choice('MMMNNDIS=XHP')}" for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, "*")], "i long, c string")
    ops = cigar.ops(F.col("c"))
    got = {r.i: r for r in frame.select("i", cigar.exons(ops, F.lit(100), 3, 3, 50).alias("x"), cigar.query_length(ops).alias("q"), cigar.introns(ops, F.lit(100), 3).alias("n")).collect()}
    for i, t in enumerate(texts):
        assert [tuple(x) for x in got[i].x] == walk(t, 100)
        assert got[i].q == sum(int(n) for n, op in re.findall("([0-9]+)([MISH=X])", t))
    assert got[900].x is None


def test_strand(spark):
    rows = spark.createDataFrame([("+", 16), ("-", 0), ("?", 0), (None, 16), (None, 0)], "xs string, flag int")
    assert [r[0] for r in rows.select(strand(F.col("xs"), F.col("flag"))).collect()] == [False, True, True, True, False]


def aln(**k):
    row = dict(ord=0, qname="r", flag=0, tid=0, pos=0, cigar="100M", l_qseq=100, nm=0, nh=1, xs=None) | k
    return tuple(row[c.split()[0]] for c in ALN.split(", "))


def test_selection_follows_the_running_best(spark):
    rng = random.Random(5)
    rows, groups = [], defaultdict(list)
    for i in range(1500):
        q, nm = f"r{rng.randrange(500)}", rng.choice([0, 1, 2, 10, 10, 30])
        rows.append(aln(ord=i, qname=q, nm=nm, flag=rng.choice([0, 0, 0, 4]), cigar=rng.choice(["100M", "50M40N50M", "20S80M"])))
    rows += [aln(ord=5000, qname="null", nm=None), aln(ord=5001, qname="zero", l_qseq=0, cigar="10M", nm=5), aln(ord=5002, qname="clip", l_qseq=0, cigar="5S10M", nm=0)]
    for r in rows:
        d = dict(zip([c.split()[0] for c in ALN.split(", ")], r, strict=True))
        covered = d["l_qseq"] - sum(int(n) for n in re.findall("^([0-9]+)S", d["cigar"]))
        if d["flag"] & 4 or d["nm"] is None or (covered / d["l_qseq"] < 0.67 if d["l_qseq"] else covered != 0) or covered - d["nm"] < np.float32(0.75) * covered:
            continue
        groups[d["qname"]].append((covered - d["nm"], d["ord"]))
    want = set()
    for items in groups.values():
        best, second, who = None, 0, None
        for score, ord_ in items:
            if best is None:
                best, who = score, ord_
            elif score > best:
                best, second, who = score, best, ord_
            elif score > second:
                second = score
        if np.float32(second) < np.float32(0.98) * np.float32(best):
            want.add(who)
    got = {r.ord for r in select.filtered(spark.createDataFrame(rows, ALN)).collect()}
    assert got == want


def test_removal_uses_the_tools_coordinates(spark):
    rows = select.measured(spark.createDataFrame([aln(ord=i, qname=str(i), pos=p, cigar="10M", l_qseq=10) for i, p in enumerate((89, 90, 91, 200, 201, 195))], ALN))
    removal = spark.createDataFrame([(0, 100, 200), (1, 1, 1000)], "tid int, start int, end int")
    # 0-based places are held against 1-based bounds, as they are.
    assert {r.ord for r in select.outside(rows, removal).collect()} == {0, 1, 4}


def test_runs_begin_where_names_change(spark):
    rows = spark.createDataFrame([("f", i, q) for i, q in enumerate("aabba")], "file string, ord long, qname string")
    assert [r.run for r in select.runs(rows).orderBy("ord").collect()] == [1, 1, 2, 2, 3]


def test_junctions(spark):
    genome = spark.createDataFrame([("c", "AAAAAgtCCCCagTTTTctGGGGGacAA")], "chrom string, sequence string")
    rows = spark.createDataFrame([(0, "a", 2, 0, "c", 0, "5M8N5M", 1), (1, "b", 2, 0, "c", 0, "5M8N5M", 2), (2, "c", 2, 0, "c", 0, "17M9N2M", None), (3, "d", 0, 0, "c", 0, "5M8N5M", 1), (4, "e", 6, 0, "c", 0, "5M8N5M", 1), (5, "f", 2, 0, "c", 0, "5M2N5M", 1)], "ord long, qname string, flag int, tid int, chrom string, pos int, cigar string, nh int")
    got = {(r.don, r.acc): (r.strand, r.motif, r.uniq_c, r.multi_c) for r in junctions.counted(junctions.extracted(rows, genome=genome)).collect()}
    assert got == {(6, 13): (1, 1, 1, 1), (18, 26): (2, 2, 0, 1)}


def test_transcripts_of_alignments(spark):
    rows = from_alignments(spark.createDataFrame([aln(pos=9, cigar="10M20N10M"), aln(ord=1, flag=4)], ALN), Params()).collect()
    assert [(r.start, r.end, len(r.exons)) for r in rows] == [(10, 49, 2)]


@pytest.mark.parametrize(("bin_size", "crowd"), [(8, 5), (64, 3), (64, 1000), (1024, 30)])
def test_binned_join_equals_all_pairs(spark, monkeypatch, bin_size, crowd):
    monkeypatch.setattr(intervals, "BIN", bin_size)
    monkeypatch.setattr(intervals, "FINE", 3)
    monkeypatch.setattr(intervals, "CROWD", crowd)
    rng = random.Random(bin_size)
    spans = lambda n: [(i, rng.randrange(3), a := rng.choice([rng.randrange(300), 100 + rng.randrange(9)]), a + rng.choice([rng.randrange(60), rng.randrange(3), 250])) for i in range(n)]
    a, b = spans(150), spans(120)
    left = spark.createDataFrame([*a, (998, None, 1, 9), (999, 1, None, 9)], "i int, tid int, start int, end int")
    right = spark.createDataFrame([*b, (998, None, 1, 9)], "j int, tid int, start int, end int")
    want = {(i, j) for i, t, s, e in a for j, u, v, w in b if t == u and e > v and w > s}
    rows = intervals.overlap_join(left, right, ["tid"]).collect()
    assert {(r.i, r.j) for r in rows} == want and len(rows) == len(want)
    anti = intervals.overlap_join(left, right, ["tid"], "left_anti", ["i"])
    assert {r.i for r in anti.collect()} == {i for i, *_ in a} - {i for i, _ in want} | {998, 999}
    semi = intervals.overlap_join(left, right.limit(0), ["tid"], "left_semi", ["i"])
    assert semi.count() == 0


def test_crowded_loci_are_cut_and_dealt(spark, monkeypatch):
    monkeypatch.setattr(intervals, "CROWD", 200)
    # One place with many reads, and a stretch with many short ones.
    left = spark.range(6000).selectExpr("id", "1 AS tid", "CAST(IF(id % 2 = 0, 50000, 100000 + id) AS INT) AS start").selectExpr("*", "start + IF(id % 2 = 0, 40000, 20) AS end")
    right = spark.range(40).selectExpr("id AS j", "1 AS tid", "CAST(id * 3000 AS INT) AS start", "CAST(id * 3000 + 900 AS INT) AS end")
    a, b = intervals.sides(left, right, ["tid"])
    groups = a.groupBy("own", "bin", "part").count()
    assert groups.agg({"count": "max"}).head()[0] < 300 and groups.where("part > 0").count() > 20
    assert b.groupBy("own", "bin", "part").count().agg({"count": "max"}).head()[0] <= 8
    plain = left.alias("x").join(right.alias("y"), F.expr("x.end > y.start AND y.end > x.start")).select("id", "j")
    got = intervals.overlap_join(left, right, ["tid"]).select("id", "j")
    assert got.count() == plain.count() > 3000 and got.exceptAll(plain).isEmpty()


def test_islands(spark, monkeypatch):
    monkeypatch.setattr(intervals, "BLOCK", 50)
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), a := rng.randrange(2000), a + rng.randrange(40)) for i in range(300)]
    got = {r.ord: r.island for r in intervals.islands(spark.createDataFrame(rows, "ord long, tid int, start int, end int")).collect()}
    for t in range(3):
        far = head = None
        for i, _, s, e in sorted((r for r in rows if r[1] == t), key=lambda r: (r[2], r[0])):
            if far is None or s > far:
                head = s
            far = max(far or 0, e)
            assert got[i] == head
