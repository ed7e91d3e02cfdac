"""Intervals: predicates, a binned overlap join, islands and unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from isoframe.functions import ordered
from isoframe.plans.cut import kept_tidily as kept

#: Bases of a bin of the overlap join.  A bin in which many spans start is cut
#: into up to 2^FINE narrower ones.
BIN, FINE = 1 << 14, 6
#: Spans in a bin from which it is cut, or dealt over parts; at least one in MOST of
#: all, so that the tables of such bins have no more than MOST rows.
CROWD, MOST = 50_000, 20_000
#: Bases of a block of the island search.
BLOCK = 1 << 20


def overlap(a: Column, b: Column) -> Column:
    """Whether two inclusive spans share a base."""
    return ~((a["start"] > b["end"]) | (b["start"] > a["end"]))


def overlap_fraction(a: Column, b: Column) -> Column:
    """Shared bases by those of the shorter span, as a 32-bit float."""
    shared = F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]) + 1
    shorter = F.least(a["end"] - a["start"], b["end"] - b["start"]) + 1
    return F.when(overlap(a, b), (shared / shorter).cast("float")).otherwise(F.lit(0).cast("float"))


def _crowded(counts: DataFrame) -> list[Row]:
    """The rows of ``counts`` with so large an n that a task should share them.

    They go through the driver: no more than MOST, and mostly none, so that plans
    which would use them several times needn't find them each time.
    """
    found = counts.where(F.col("n") > CROWD).orderBy(F.desc("n")).limit(MOST).collect()
    total = counts.agg(F.sum("n")).head()[0] if found else 0
    return [r for r in found if r["n"] * MOST > total]


def _bins(spans: DataFrame, cuts: DataFrame | None, keys: list[str]) -> DataFrame:
    """``spans`` with ``own`` and ``bin`` for each bin that they touch.

    A bin is known by its first base and width in one number; ``own`` is whether the
    span starts there.  ``cuts`` has the wide bins that are cut, and how often.
    """
    low, high = (F.floor(F.col(c) / BIN) for c in ("start", "end"))
    wide = spans.withColumn("wide", F.explode(F.sequence(low, high)))
    if cuts is None:
        return wide.withColumn("own", F.col("wide") == low).withColumn("bin", F.col("wide") * (FINE + 1)).drop("wide")
    wide = wide.join(F.broadcast(cuts), [*keys, "wide"], "left")
    level = F.coalesce("level", F.lit(0))
    width = F.lit(BIN) / F.pow(F.lit(2), level)
    first = F.floor(F.greatest(F.col("start"), F.col("wide") * BIN) / width)
    last = F.floor(F.least(F.col("end"), (F.col("wide") + 1) * BIN - 1) / width)
    cut = wide.withColumn("narrow", F.explode(F.sequence(first, last)))
    own = F.col("narrow") == F.floor(F.col("start") / width)
    return cut.withColumn("own", own).withColumn("bin", F.col("narrow") * (FINE + 1) + level).drop("wide", "level", "narrow")


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", ids: list[str] | None = None) -> DataFrame:
    """Rows of both sides with equal keys whose spans share more than an end.

    Both sides have columns start and end; the right side's columns must have
    other names than the left's but for keys, start and end, which it loses to
    ``start_2`` and ``end_2``.  ``how`` is inner, left_semi or left_anti; the
    last two need ``ids``, columns that tell the left rows apart and aren't null.

    Bins are joined by equality.  A bin in which many left spans start is cut into
    narrower ones, by how many start there.  Of a pair, the right span starts either in a
    bin before the left one's start or in the same: then it is found where the
    left span starts, once, among the right spans that touch that bin.  Or it
    starts in a later bin, and is found there among the left spans that reach
    into it.  A bin with many left spans is dealt over parts, each with the right
    spans, so a locus with any number of reads is no single task.

    The left spans are counted as soon as they are given, again if bins are crowded, so the left side of
    an inner join should be cheap to read; for the others ids and spans are written first.
    """
    if how != "inner":
        spans = kept(left.select(*ids, *keys, "start", "end"), "spans")
        met = overlap_join(spans, right.select(*keys, "start", "end"), keys).select(ids).distinct()
        return left.join(met, ids, how)
    a, b = sides(left, right, keys)
    meets = (F.col("end") > F.col("start_2")) & (F.col("end_2") > F.col("start"))
    return a.join(b, [*keys, "own", "bin", "part"]).where(meets).drop("own", "bin", "part")


def sides(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of the overlap join with own, bin and part, which meet by equality."""
    places = left.select(*keys, "start", "end")
    count = lambda cuts: _bins(places, cuts, keys).groupBy(*keys, "own", "bin").agg(F.count("*").alias("n"))
    loads, cuts = count(None), None
    crowded = _crowded(loads)
    if begun := [r for r in crowded if r["own"]]:
        level = F.least(F.greatest(F.ceil(F.log2(F.col("n") / CROWD)).cast("int"), F.lit(1)), F.lit(FINE))
        cuts = left.sparkSession.createDataFrame(begun, loads.schema).select(*keys, (F.col("bin") / (FINE + 1)).cast("long").alias("wide"), level.alias("level"))
        crowded = _crowded(count(cuts))
    others = [c for c in right.columns if c not in (*keys, "start", "end")]
    a = _bins(left, cuts, keys)
    b = _bins(right, cuts, keys).select(*keys, F.col("start").alias("start_2"), F.col("end").alias("end_2"), *others, "own", "bin")
    # The left spans that start in a bin meet all right ones there; those that
    # reach into it meet the right ones that start there.
    b = b.withColumn("own", F.explode(F.when(F.col("own"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    if not crowded:
        return a.withColumn("part", F.lit(0)), b.withColumn("part", F.lit(0))
    parts = F.broadcast(left.sparkSession.createDataFrame(crowded, loads.schema).select(*keys, "own", "bin", F.ceil(F.col("n") / CROWD).cast("int").alias("parts")))
    a = a.join(parts, [*keys, "own", "bin"], "left")
    a = a.select(*left.columns, "own", "bin", F.pmod(F.xxhash64(*left.columns), F.coalesce("parts", F.lit(1))).cast("int").alias("part"))
    b = b.join(parts, [*keys, "own", "bin"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return a, b


def _headed(starts: DataFrame) -> DataFrame:
    """``starts`` (tid, start, end; a row for each start) with ``island``.

    Running maxima are taken within blocks of a contig and carried over from the
    blocks before, so no task sees more than the BLOCK starts of one.
    """
    blocked = starts.withColumn("block", F.floor(F.col("start") / BLOCK))
    blocks = Window.partitionBy("tid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = Window.partitionBy("tid", "block").orderBy("start")
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    reach = blocked.groupBy("tid", "block").agg(F.max("end").alias("reach")).withColumn("carried", F.max("reach").over(blocks)).drop("reach")
    at = blocked.join(reach, ["tid", "block"]).withColumn("far", F.greatest("carried", F.max("end").over(before)))
    at = at.withColumn("head", F.when(F.col("far").isNull() | (F.col("start") > F.col("far")), F.col("start")))
    heads = at.groupBy("tid", "block").agg(F.max("head").alias("h")).withColumn("carried_head", F.max("h").over(blocks)).drop("h")
    out = at.join(heads, ["tid", "block"]).withColumn("island", F.coalesce(F.max("head").over(rows), F.col("carried_head")))
    return out.drop("block", "carried", "far", "head", "carried_head")


def islands(spans: DataFrame) -> DataFrame:
    """``spans`` (tid, start, end, ord) with ``island``: where its island begins.

    An island begins at a span that starts after the ends of all before it.  Spans
    of equal start are of one island, so distinct starts are looked at, however
    many spans begin there.
    """
    # Looked at several times, by far fewer rows than there are spans.
    starts = _headed(kept(spans.groupBy("tid", "start").agg(F.max("end").alias("end")), "starts"))
    return spans.join(starts.select("tid", "start", "island"), ["tid", "start"]).select(*spans.columns, "island")


def union(spans: DataFrame) -> DataFrame:
    """Unions of overlapping spans: tid, start, end and how many they hold."""
    starts = _headed(kept(spans.groupBy("tid", "start").agg(F.max("end").alias("end"), F.count("*").alias("n")), "starts"))
    return starts.groupBy("tid", "island").agg(F.max("end").alias("end"), F.sum("n").alias("n")).select("tid", F.col("island").alias("start"), "end", "n")


def cut_at(spans: DataFrame, sites: DataFrame) -> DataFrame:
    """Disjoint ``spans`` (tid, start, end) cut before each site (tid, site) in them.

    A sweep over starts and sites in order, contig by contig: each site gets the
    span that began last before it, carried from range to range, and cuts it if it
    lies in it.
    """
    begins = spans.select(F.col("tid").alias("file"), (2 * F.col("start").cast("long")).alias("ord"), F.col("start").alias("at"), F.struct("start", "end").alias("span"))
    others = sites.select("tid", "site").distinct().select(F.col("tid").alias("file"), (2 * F.col("site").cast("long") + 1).alias("ord"), F.col("site").alias("at"))
    swept = ordered.filled(begins.unionByName(others, allowMissingColumns=True), F.col("span"), "of").select("file", "at", "of.start", "of.end", "span")
    cuts = swept.where(F.col("span").isNotNull() | ((F.col("at") > F.col("start")) & (F.col("at") <= F.col("end"))))
    next_ = F.lead("at").over(Window.partitionBy("file", "start").orderBy("at"))
    return cuts.select(F.col("file").alias("tid"), F.col("at").alias("start"), F.coalesce(next_ - 1, F.col("end")).alias("end"))
