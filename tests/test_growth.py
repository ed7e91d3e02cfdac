"""Steps whose work or memory a task must not grow faster than the tables."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

from isoframe.functions import intervals
from isoframe.operators import junctions
from isoframe.plans import cut, fixtures, queries
from isoframe.sources import bam, placed

SF = "/root/testdata/sf0.001"


def _plan(rows, kind: str = "optimizedPlan") -> str:
    return getattr(rows._jdf.queryExecution(), kind)().toString()


def test_cigar_strings_are_parsed_once(spark):
    # Two searches of a string are one parse.
    for name in ("cigar_exons", "best_alignment"):
        assert _plan(queries.QUERIES[name](spark, SF)).count("regexp_extract_all") == 2, name


def test_tables_are_dealt_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "ROWS", 100)
    n = fixtures.parts(spark, SF)
    assert n > 50
    for name in ("transcripts_nested", "transcript_extent"):
        plan = _plan(queries.QUERIES[name](spark, SF), "executedPlan")
        # No shuffle but the one of each table.
        assert plan.count("Exchange hashpartitioning") == plan.count(f", {n})"), name
    plan = _plan(queries.QUERIES["merge_identical_chain"](spark, SF), "executedPlan")
    assert plan.count("Exchange hashpartitioning") == plan.count(f", {n})")


def test_islands_look_at_distinct_starts(spark, monkeypatch):
    seen = []
    headed = intervals._headed
    monkeypatch.setattr(intervals, "_headed", lambda starts: (seen.append(starts.count()), headed(starts))[1])
    rng = random.Random(3)
    rows = [(rng.randrange(2), a := rng.randrange(60), a + rng.randrange(-1, 4), k) for k in range(900)]
    spans = spark.createDataFrame(rows, "tid int, start int, end int, ord long")
    expected, far, head = {}, {}, {}
    for tid, start, end, ord_ in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        if tid not in far or start > far[tid]:
            head[tid] = start
        far[tid] = max(far.get(tid, end), end)
        expected[ord_] = head[tid]
    assert {r.ord: r.island for r in intervals.islands(spans).collect()} == expected
    united = {(r.tid, r.start): r.n for r in intervals.union(spans).collect()}
    counts: dict = {}
    for tid, _, _, ord_ in rows:
        counts[tid, expected[ord_]] = counts.get((tid, expected[ord_]), 0) + 1
    assert united == counts and max(seen) <= 120


def test_first_records_are_not_searched(spark, tmp_path, monkeypatch):
    rows, contigs = queries._records(spark, SF)
    bam.write(rows, contigs, str(tmp_path / "out"))
    path = str(next((tmp_path / "out").glob("*.bam")))
    known = bam.about(path)
    monkeypatch.setattr(bam, "_guessed", None)
    first, _, n = bam.scan(path, known, 0, 1 << 25, None)
    assert first == known[1] and n > 0


def test_placed_files_grow_with_the_tables(spark, monkeypatch):
    asked = []
    write = placed.write
    monkeypatch.setattr(queries, "parts", lambda *_: 20)
    monkeypatch.setattr(placed, "write", lambda rows, path, files: (asked.append(files), write(rows, path, files)))
    queries.QUERIES["region_read"](spark, SF)
    assert asked == [20]


def test_runs_read_their_rows_once(spark):
    plan = _plan(queries.QUERIES["best_of_runs"](spark, SF))
    assert "regexp_extract_all" not in plan


def test_only_common_introns_are_dealt(spark, monkeypatch):
    rows = spark.range(300).selectExpr("id AS ord", "0 AS flag", "0 AS tid", "'c' AS chrom", "IF(id < 200, 5, CAST(id AS INT)) AS pos", "'5M30N5M' AS cigar", "1 AS nh")
    genome = spark.createDataFrame([("c", "GTAGC" * 100)], "chrom string, sequence string")
    whole = junctions.extracted(rows, genome=genome, paired=False).orderBy("ord").collect()
    monkeypatch.setattr(junctions, "CROWD", 50)
    assert junctions.extracted(rows, genome=genome, paired=False).orderBy("ord").collect() == whole
    assert len(whole) == 300 and "sequence(0, 15" not in _plan(junctions.extracted(rows, genome=genome, paired=False), "analyzed")


def _jobs(spark, make) -> int:
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    make()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_classes_take_few_jobs(spark):
    # Each of them leaves its share in the driver's memory; there were 79.
    assert _jobs(spark, lambda: queries.QUERIES["classify_compat"](spark, SF).count()) <= 60


def test_joins_of_few_spans_count_them_once(spark):
    spans = spark.range(50).selectExpr("1 AS tid", "CAST(id AS INT) AS start", "CAST(id + 5 AS INT) AS end")
    made = []
    assert _jobs(spark, lambda: made.append(intervals.overlap_join(spans, spans, ["tid"]))) <= 2
    # No table of crowded bins is looked at, as there are none.
    assert _plan(made[0], "analyzed").count("Join") == 1


def test_only_classes_stay_of_what_they_are_made_from(spark):
    folder = Path(cut.shared_dir(spark).removeprefix("file://"))
    before = set(folder.glob("*"))
    assert queries.QUERIES["classify_compat"](spark, SF).count() > 0
    assert [p.name.rpartition("-")[0] for p in set(folder.glob("*")) - before] == ["classified"]


def test_only_compressed_text_stays_of_written_sam(spark):
    folder = Path(cut.shared_dir(spark).removeprefix("file://"))
    before = set(folder.glob("*"))
    queries.QUERIES["sam_filtered"](spark, SF)
    (left,) = set(folder.glob("*")) - before
    assert left.name.startswith("sam-") and {p.suffix for p in left.glob("part-*")} == {".gz"}
