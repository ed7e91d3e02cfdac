from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isoframe.operators import classify, evidence, fusion, merge, report, split
from isoframe.operators.transcripts import extent
from isoframe.params import Params
from isoframe.plans import cut, update
from isoframe.sources import gtf, sam

T = "ord long, trans_id string, gene_id string, tid int, is_rev boolean, exons array<struct<start:int,end:int>>"
A = [(100, 200), (300, 400), (500, 600), (700, 800)]


def frame(spark, transcripts, gene="g"):
    return extent(spark.createDataFrame([(i, f"t{i}", f"{gene}{i}", 0, False, e) for i, e in enumerate(transcripts)], T))


def bits(flags):
    return "".join(str(int(x)) for x in flags)


#: Hand-made cases: exons, class, novel exons, sites and junctions, by mode.
GOLDEN = [
    (A, True, "novel", "0000", "010000", "000"),
    (A, False, "known", "0000", "000000", "000"),
    (A[1:], True, "known", "000", "0000", "00"),
    (A[1:], False, "known", "000", "0000", "00"),
    ([A[0], A[2], A[3]], True, "novel", "000", "0100", "10"),
    ([A[0], A[2], A[3]], False, "known", "000", "0000", "10"),
    ([(150, 200), (300, 420), (500, 600), (700, 750)], True, "novel", "1101", "011000", "010"),
    ([(150, 200), (300, 420), (500, 600), (700, 750)], False, "novel", "1101", "001000", "010"),
    ([(120, 210), (310, 390)], True, "unrecognized", "11", "11", "1"),
    ([(120, 210), (310, 390)], False, "unrecognized", "11", "11", "1"),
]


@pytest.mark.parametrize("exons,compat,kind,exon,site,joint", GOLDEN)
def test_golden_classes(spark, exons, compat, kind, exon, site, joint):
    row = classify.classified(frame(spark, [exons]), frame(spark, [A]), Params(compat=compat)).head()
    assert row["class"] == kind
    assert (bits(row.novel_exon), bits(row.novel_junction)) == (exon, joint)
    assert "".join(bits(p) for p in zip(row.novel_don, row.novel_acc)) == site


def test_distance_is_as_equality_where_sites_are_exact(spark):
    rng = random.Random(7)
    some = lambda: [(s := 100 + 200 * k, s + rng.choice([80, 100])) for k in sorted(rng.sample(range(8), rng.randrange(1, 5)))]
    reads, annotation = frame(spark, [some() for _ in range(60)]), frame(spark, [some() for _ in range(20)])
    near = {r.ord: r for r in classify.classified(reads, annotation, Params(site_distance=3)).collect()}
    for r in classify.classified(reads, annotation).collect():
        assert (r["class"], r.novel_exon, r.novel_junction) == (near[r.ord]["class"], near[r.ord].novel_exon, near[r.ord].novel_junction)


def test_first_known_ends_the_visit(spark):
    reads = frame(spark, [A[1:]])
    row = classify.classified(reads, frame(spark, [A, [(300, 400), (500, 650)], A[1:]], "h")).head()
    assert (row["class"], row.gene_id) == ("known", "h0")
    row = classify.classified(frame(spark, [A]), frame(spark, [A, [(300, 400), (500, 650)], [(90, 95), (900, 950)]], "h")).head()
    assert (row["class"], row.gene_id) == ("novel", "h1")
    row = classify.classified(frame(spark, [[(5000, 5100)]]), frame(spark, [A])).head()
    assert row["class"] == "unrecognized" and row.gene_id is None and row.full_3 and not row.full_1


def judged(spark, junctions, params=Params()):
    reads = frame(spark, [A, [(100, 200), (320, 400), (500, 600), (700, 800)]])
    rows = None if junctions is None else spark.createDataFrame(junctions, "tid int, don int, acc int, uniq_c int, multi_c int")
    return {r.ord: r for r in evidence.supported(classify.classified(reads, frame(spark, [A]), params), rows, params).collect()}


def test_evidence(spark):
    assert not any(r.unreliable or r.tested for r in judged(spark, None).values())
    assert not any(r.tested for r in judged(spark, []).values())
    rows = judged(spark, [(0, 9000, 9100, 5, 0)])
    assert rows[1].unreliable and not any(rows[1].unreliable_junction)
    rows = judged(spark, [(0, 401, 499, 5, 0)])
    assert bits(rows[1].unreliable_junction) == "100" and rows[1].unreliable and not rows[0].unreliable
    assert not judged(spark, [(0, 201, 319, 1, 0)])[1].unreliable
    assert judged(spark, [(0, 201, 319, 0, 9)])[1].unreliable
    assert not judged(spark, [(0, 201, 319, 0, 9)], Params(use_multi=True))[1].unreliable
    assert not judged(spark, [(0, 203, 317, 1, 0)], Params(site_distance=2))[1].unreliable


def test_split(spark):
    five = [*A, (900, 1000), (1100, 1200)]
    rows = [(0, "r", "g", 0, False, five, [False] * 6, [True, False, False, True, False], [False, True, False, False, False])]
    schema = T + ", novel_exon array<boolean>, novel_junction array<boolean>, unreliable_junction array<boolean>"
    reads = spark.createDataFrame(rows, schema).withColumn("novel_don", F.col("novel_junction")).withColumn("novel_acc", F.col("novel_junction"))
    got = split.pieces(reads).orderBy("piece").collect()
    assert [(r.trans_id, r.start, r.end, bits(r.novel_junction)) for r in got] == [("r.split.0", 100, 400, "1"), ("r.split.1", 500, 1200, "010")]


MERGES = [
    ([A, [(110, 200), (300, 400), (500, 600), (700, 850)]], [([(100, 200), (300, 400), (500, 600), (700, 850)], 2)]),
    ([A[:3], A], [(A[:3], 1)]),
    ([A, A[:3]], [(A, 1)]),
    ([A, [(510, 600), (700, 800), (900, 950)]], [(A, 1)]),
    ([[(100, 200)], [(110, 215)], [(150, 400)]], [([(100, 215)], 2), ([(150, 400)], 1)]),
    ([[(100, 200), (300, 900)], [(150, 160)], [(170, 200), (300, 880)]], [([(100, 200), (300, 900)], 1), ([(150, 160)], 1), ([(170, 200), (300, 880)], 1)]),
]


@pytest.mark.parametrize("given,want", MERGES)
def test_golden_merges(given, want):
    rows = [dict(tid=0, is_rev=False, start=e[0][0], end=e[-1][1], cov=1, exons=[list(x) for x in e]) for e in given]
    assert [([tuple(x) for x in r["exons"]], r["cov"]) for r in merge.fold(rows) if not r["absorbed"]] == want


def test_merging_by_islands_equals_merging_all(spark):
    rng = random.Random(9)
    given = []
    for _ in range(250):
        base, tid = 1000 * rng.randrange(12), rng.randrange(2)
        exons = [(base + 100 * k + rng.choice([0, 0, 5]), base + 100 * k + 50 + rng.choice([0, 0, 7])) for k in sorted(rng.sample(range(6), rng.randrange(1, 5)))]
        given.append((tid, exons))
    rows = [(i, f"t{i}", "g", t, rng.random() < 0.5, e) for i, (t, e) in enumerate(given)]
    frame_ = extent(spark.createDataFrame(rows, T))
    ordered = sorted(rows, key=lambda r: (r[3], r[5][0][0], r[0]))
    for params in (Params(), Params(force_strand=True, site_distance=5, end_distance=60)):
        want = merge.fold([dict(ord=r[0], tid=r[3], is_rev=r[4], start=r[5][0][0], end=r[5][-1][1], cov=1, exons=[list(x) for x in r[5]]) for r in ordered], params)
        got = {r.ord: r for r in merge.merged(frame_, params).collect()}
        for w in want:
            g = got[w["ord"]]
            assert (g.absorbed, g.cov, [tuple(x) for x in g.exons]) == (w["absorbed"], w["cov"], [tuple(x) for x in w["exons"]])
        kept = merge.unique(frame_, params)
        assert merge.unique(kept, params).count() == kept.count()


def greedy(parts, rlen):
    ratio = lambda a, b: 0.0 if a["s"] > b["e"] or b["s"] > a["e"] else (a["e"] - b["s"] + 1 if a["e"] - b["s"] + 1 > 0 else b["e"] - a["s"] + 1) / (min(a["e"] - a["s"], b["e"] - b["s"]) + 1)

    def fits(a, b):
        if np.float32(ratio(a, b)) > np.float32(0.1):
            return False
        if a["t"] != b["t"]:
            return True
        gap = max(a["f"] - b["l"], b["f"] - a["l"])
        return gap > 0 and gap >= 100000

    parts = sorted(parts, key=lambda p: (-p["score"], p["ed"], p["ord"]))
    taken = parts[:1]
    for p in parts[1:]:
        if (p["e"] - p["s"] + 1) / rlen >= np.float32(0.1) and all(fits(t, p) for t in taken):
            taken.append(p)
            if len({x for t in taken for x in range(t["s"], t["e"] + 1)}) / rlen >= np.float32(0.99):
                return taken
    return None


def test_fusions(spark):
    rng = random.Random(13)
    rows, want = [], {}
    for q in range(400):
        parts = []
        for k in range(rng.randrange(1, 6)):
            s = rng.choice([1, 1, 480, 501, 505, 300])
            p = dict(score=rng.randrange(5), ed=rng.randrange(3), ord=k, t=rng.randrange(3), s=s, e=rng.choice([s + 60, 500, 520, 1000, 1000]), f=(f := rng.randrange(40) * 10000 + 1), l=f + 500)
            if p["e"] > s:
                parts.append(p)
                rows.append((str(q), k, p["score"], p["ed"], p["t"], False, 1000, s, p["e"], p["f"], p["l"]))
        found = greedy(parts, 1000) if parts else None
        if found and len(found) == 2:
            a, b = (found[0], found[1]) if found[0]["s"] < found[1]["s"] else (found[1], found[0])
            want[str(q)] = (a["t"], a["f"], b["t"], b["f"])
    schema = "qname string, ord long, score int, ed int, tid int, is_rev boolean, rlen int, read_start int, read_end int, ref_start int, ref_end int"
    got = {r.qname: (r.left_tid, r.left_ref_start, r.right_tid, r.right_ref_start) for r in fusion.fusions(spark.createDataFrame(rows, schema)).collect()}
    assert got == want and len(want) > 10
    assert [fusion.size(x) for x in ("7", "2k", "1.5M", "1G")] == [7, 2000, 1_500_000, 10**9]


def test_workflow(spark):
    schema = "ord long, qname string, flag int, tid int, pos int, cigar string, l_qseq int, nm int, nh int, xs string"
    rows = [(0, "known", 0, 0, 299, "101M99N101M99N101M", 303, 0, 1, "+"), (1, "novel", 0, 0, 99, "101M119N81M99N101M99N101M", 384, 0, 1, "+"), (2, "other", 0, 0, 5000, "100M", 100, 0, 1, None), (3, "again", 0, 0, 109, "91M119N81M99N101M99N121M", 394, 0, 1, "+")]
    annotation = frame(spark, [A])
    out = update.run(spark.createDataFrame(rows, schema), annotation, None)
    assert {r.trans_id: r["class"] for r in out["reads"].collect()} == {"known": "known", "novel": "novel", "other": "unrecognized", "again": "novel"}
    new = out["updated"].collect()
    assert [(r.trans_id, r.cov, r.start, r.end) for r in new] == [("novel", 2, 100, 820)]
    counts = {(r.section, r.metric): r.value for r in out["summary"].collect()}
    assert counts["known", "transcripts"] == 1 and counts["updated", "transcripts"] == 1 and counts["novel", "transcripts"] == 2 and counts["novel", "unique_novel_reliable"] == 1
    assert out["annotation"].count() == 2
    assert {(r.start, r.end, r.kind, r.score) for r in out["novel_exons"].collect()} == {(320, 400, "I", 2)}
    detail = {r.trans_id: r for r in out["detail"].collect()}
    assert detail["other"].gene_id == "NA" and detail["known"].exon_index == "NA" and detail["novel"].junction_index == "0"
    both = update.combined([out["updated"], out["updated"]], annotation).where("is_new").collect()
    assert [r.cov for r in both] == [3]
    assert report.gene_runs(annotation).head().runs == 1


def test_fusion_at_the_limit(spark):
    """Parts that cover 99 of 100 bases suffice, in 32-bit arithmetic."""
    schema = "qname string, ord long, score int, ed int, tid int, is_rev boolean, rlen int, read_start int, read_end int, ref_start int, ref_end int"
    rows = [("q", 0, 9, 0, 0, False, 1000, 1, 500, 1, 500), ("q", 1, 8, 0, 1, True, 1000, 501, 990, 7001, 7490), ("r", 2, 9, 0, 0, False, 1000, 1, 500, 1, 500), ("r", 3, 8, 0, 1, True, 1000, 501, 989, 7001, 7490)]
    parts = spark.createDataFrame(rows, schema)
    found = fusion.fusions(parts)
    assert [(r.qname, r.left_tid, r.right_tid, r.ords) for r in found.collect()] == [("q", 0, 1, [0, 1])]
    assert [r.ord for r in fusion.records(parts, found).orderBy("ord").collect()] == [0, 1]
    assert [fusion.size(x) for x in ("0.0015k", "0.1234567M")] == [2, 123457]


def test_split_pieces_merge_when_their_read_comes(spark):
    """A piece that starts late goes before a read that starts after its read."""
    late = [(500, 600), (700, 800), (900, 950)]
    rows = [(0, 1, 500, 100, late), (1, 0, 300, 300, [(300, 400), *late]), (2, 0, 460, 460, late)]
    pieces = [(o, p, 0, False, s, e[-1][1], 1, e, rs, e[-1][1]) for o, p, s, rs, e in rows]
    schema = "ord long, piece int, tid int, is_rev boolean, start int, end int, cov int, exons array<struct<start:int,end:int>>, read_start int, read_end int"
    got = {r.ord: (r.absorbed, r.cov) for r in merge.merged(spark.createDataFrame(pieces, schema)).collect()}
    # The piece is first; the longer read is a part of the same chain, and so goes.
    assert got == {0: (False, 2), 1: (True, 1), 2: (True, 1)}
    plain = {r.ord: (r.absorbed, r.cov) for r in merge.merged(spark.createDataFrame(pieces, schema).drop("read_start", "read_end")).collect()}
    assert plain == {1: (False, 1), 2: (True, 1), 0: (True, 1)}


ANNO = """chr1\ts\ttranscript\t100\t800\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G1";
chr1\ts\texon\t100\t200\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G1";
chr1\ts\texon\t300\t400\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G1";
chr1\ts\texon\t500\t600\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G1";
chr1\ts\texon\t700\t800\t.\t+\t.\tgene_id "g1"; transcript_id "t1"; gene_name "G1";
chr2\ts\ttranscript\t50000\t50400\t.\t-\t.\tgene_id "g2"; transcript_id "t2"; gene_name "G2";
chr2\ts\texon\t50000\t50100\t.\t-\t.\tgene_id "g2"; transcript_id "t2"; gene_name "G2";
chr2\ts\texon\t50300\t50400\t.\t-\t.\tgene_id "g2"; transcript_id "t2"; gene_name "G2";
"""
HEAD = "@HD\tVN:1.6\n@SQ\tSN:chr2\tLN:100000\n@SQ\tSN:chr1\tLN:100000\n"


def test_files_to_a_written_annotation(spark, tmp_path):
    """GTF and two SAM files with headers in, an updated GTF out."""
    line = lambda name, flag, chrom, pos, cigar, n: f"{name}\t{flag}\t{chrom}\t{pos}\t60\t{cigar}\t*\t0\t0\t{'A' * n}\t*\tNM:i:0\n"
    (tmp_path / "sam").mkdir()
    (tmp_path / "anno.gtf").write_text(ANNO)
    # The reads of both files have equal places in them, and one has an equal name.
    (tmp_path / "sam/a.sam").write_text(HEAD + line("r1", 0, "chr1", 100, "101M119N81M99N101M99N101M", 384) + line("same", 0, "chr2", 90000, "100M", 100))
    (tmp_path / "sam/b.sam").write_text(HEAD + line("far", 0, "chr1", 90000, "101M99N101M", 202) + line("same", 16, "chr2", 50000, "101M149N151M", 252))
    contigs = sam.header(spark, str(tmp_path / "sam"))
    assert [(r["name"], r.tid) for r in contigs.orderBy("tid").collect()] == [("chr2", 0), ("chr1", 1)]
    annotation = gtf.read(spark, str(tmp_path / "anno.gtf"), contigs.select("name", "tid"))
    records = sam.read(spark, str(tmp_path / "sam"))
    assert records.select("ord").distinct().count() == 4
    out = update.run(records, annotation)
    got = {(r.trans_id, r.start): (r["class"], r.gene_id, r.gene_name, r.seqname) for r in out["reads"].collect()}
    assert got == {
        ("r1", 100): ("novel", "g1", "G1", "chr1"), ("same", 90000): ("unrecognized", None, None, "chr2"),
        ("far", 90000): ("unrecognized", None, None, "chr1"), ("same", 50000): ("novel", "g2", "G2", "chr2"),
    }
    assert {(r.trans_id, r.seqname, r.gene_name) for r in out["detail"].collect()} == {("r1", "chr1", "G1"), ("same", "chr2", "NA"), ("far", "chr1", "NA"), ("same", "chr2", "G2")}
    gtf.write(out["annotation"], str(tmp_path / "out"), "updated")
    again = gtf.read(spark, str(tmp_path / "out"), contigs.select("name", "tid"))
    key = lambda f: sorted((r.trans_id, r.gene_id, r.gene_name, r.seqname, r.tid, r.is_rev, r.start, r.end, str(r.exons)) for r in f.collect())
    assert key(again) == key(out["annotation"]) and again.count() == 4
    assert {(r.trans_id, r.gene_name, r.is_rev) for r in again.where("trans_id IN ('r1', 'same')").collect()} == {("r1", "G1", False), ("same", "G2", True)}
    # Lines of one transcript stand together, old ones first.
    texts = [r.value.split('transcript_id "')[1].split('"')[0] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert [x for i, x in enumerate(texts) if not i or texts[i - 1] != x] == ["t1", "t2", "r1", "same"]
    sam.write(records, contigs, str(tmp_path / "sorted"), by_place=True)
    assert [(r.tid, r.pos) for r in sam.read(spark, str(tmp_path / "sorted")).orderBy("ord").collect()] == [(0, 49999), (0, 89999), (1, 99), (1, 89999)]


def test_written_tables_are_forgotten(spark):
    path = cut.new_path(spark, "x").rpartition("/")[0].removeprefix("file://")
    cut.kept(spark.range(3), "three")
    assert os.path.isdir(path)
    cut.forget(spark)
    assert not os.path.exists(path)
