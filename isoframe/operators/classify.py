"""Reads compared with annotated transcripts: known, novel or unrecognized."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isoframe.functions import intervals
from isoframe.operators.transcripts import ends, joints, starts
from isoframe.params import Params
from isoframe.plans.cut import kept_tidily as kept
from isoframe.plans.cut import settled

LEVELS = (1, 2, 3, 4, 5)


def overlapping(reads: DataFrame, annotation: DataFrame) -> DataFrame:
    """Pairs of a read and an annotated transcript that overlap.

    ``rank`` is the transcript's place in the annotation.  ``reads`` is read
    several times and should be a written table: its spans are counted, then
    joined, and exons are fetched for the pairs that were found.
    """
    return met(reads.select("ord", "tid", "start", "end"), annotation).join(reads.select("ord", "exons"), "ord")


def met(spans: DataFrame, annotation: DataFrame) -> DataFrame:
    """Pairs of spans and annotated transcripts as they are found: no pair is shuffled.

    Columns of ``spans`` beside tid, start and end are carried along.
    """
    b = annotation.select("tid", "start", "end", F.col("ord").alias("rank"), F.col("exons").alias("anno"), F.col("is_rev").alias("anno_rev"), "gene_id", *_gene_name(annotation))
    return intervals.overlap_join(spans, b, ["tid"])


def _gene_name(annotation: DataFrame) -> list[str]:
    return ["gene_name"] if "gene_name" in annotation.columns else []


def _near(x: Column, y: Column, distance: int) -> Column:
    return F.abs(x - y) <= distance


def _within(sites: Column, low: Column, high: Column) -> Column:
    return F.filter(sites, lambda x: (x >= low) & (x <= high))


def _matches(sites: Column, others: Column, distance: int) -> Column:
    """Pairs of sites that are near; at distance 0 both sides are distinct."""
    if distance == 0:
        return F.size(F.array_intersect(sites, others))
    return F.aggregate(sites, F.lit(0), lambda n, x: n + F.size(F.filter(others, lambda y: _near(x, y, distance))))


def _hits(items: Column, others: Column, distance: int, same) -> Column:
    """Places, from 0, of the items that have an equal among the others."""
    has = lambda x: F.array_contains(others, x) if distance == 0 else F.exists(others, lambda y: same(x, y))
    flags = F.transform(items, lambda x, i: F.when(has(x), i))
    return F.filter(flags, lambda i: i.isNotNull())


def _with_known(pairs: DataFrame, params: Params) -> DataFrame:
    """``pairs`` with n, m, multi, same and ``is_known``."""
    d, exons, anno = params.site_distance, F.col("exons"), F.col("anno")
    low, high = F.greatest("start", "start_2"), F.least("end", "end_2")
    rows = pairs.withColumn("n", F.size("exons")).withColumn("m", F.size("anno"))
    rows = rows.withColumn("multi", (F.col("n") > 1) & (F.col("m") > 1)).withColumn("single", (F.col("n") == 1) & (F.col("m") == 1))
    # The read's acceptors, as compared: in compat mode one exon too early.
    own = starts(exons, first=params.compat)
    there = F.size(_within(ends(exons), low, high)) + F.size(_within(starts(exons), low, high))
    anno_don, anno_acc = _within(ends(anno), low, high), _within(starts(anno), low, high)
    rows = rows.withColumn("same", F.when(F.col("multi"), _matches(anno_don, ends(exons), d) + _matches(anno_acc, own, d)).otherwise(0))
    all_same = (there == 2 * (F.col("n") - 1)) & (F.col("same") == there)
    covers = intervals.overlap_fraction(F.get(exons, F.lit(0)), F.get(anno, F.lit(0))) >= F.lit(params.single_overlap).cast("float")
    return rows.withColumn("is_known", F.when(F.col("multi"), all_same).otherwise(F.col("single") & covers))


def compared(pairs: DataFrame, params: Params = Params()) -> DataFrame:
    """What each pair says: known, shares a site, ends reached, parts found."""
    d, exons, anno = params.site_distance, F.col("exons"), F.col("anno")
    low, high = F.greatest("start", "start_2"), F.least("end", "end_2")
    own = starts(exons, first=params.compat)
    anno_don, anno_acc = _within(ends(anno), low, high), _within(starts(anno), low, high)
    rows = _with_known(pairs, params)
    rows = rows.withColumn("shares", F.col("multi") & ~F.col("is_known") & (F.col("same") > 0))
    first, last = F.get(exons, F.lit(0)), F.try_element_at("exons", F.lit(-1))
    anno_first, anno_last = F.get(anno, F.lit(0)), F.try_element_at("anno", F.lit(-1))
    touches = lambda x: F.exists("anno", lambda y: intervals.overlap(x, y))
    none = F.array().cast("array<int>")
    part = lambda found: F.when(F.col("multi"), found).otherwise(none)
    joint = lambda x, y: _near(x["don"], y["don"], d) & _near(x["acc"], y["acc"], d)
    span = lambda x, y: _near(x["start"], y["start"], d) & _near(x["end"], y["end"], d)
    return rows.select(
        "ord", "rank", "is_known", "shares", "anno_rev", "gene_id", *_gene_name(pairs),
        (first["end"] == anno_first["end"]).alias("left_1"), (last["start"] == anno_last["start"]).alias("right_1"),
        intervals.overlap(first, anno_first).alias("left_2"), intervals.overlap(last, anno_last).alias("right_2"),
        touches(first).alias("left_any"), touches(last).alias("right_any"),
        part(_hits(exons, anno, d, span)).alias("exon_hits"), part(_hits(ends(exons), anno_don, d, lambda x, y: _near(x, y, d))).alias("don_hits"),
        part(_hits(own, anno_acc, d, lambda x, y: _near(x, y, d))).alias("acc_hits"), part(_hits(joints(exons), joints(anno), d, joint)).alias("joint_hits"),
    )


def visited(pairs: DataFrame) -> DataFrame:
    """Pairs up to and with the first one that makes the read known."""
    first = F.min(F.when(F.col("is_known"), F.col("rank"))).over(Window.partitionBy("ord"))
    return pairs.withColumn("first_known", first).where(F.col("first_known").isNull() | (F.col("rank") <= F.col("first_known"))).drop("first_known")


def full_length(level: int) -> Column:
    """Whether the aggregated ends of a read meet a level from 1 to 5."""
    if level == 5:
        return F.lit(True)
    if level <= 2:
        return F.coalesce(F.col(f"left_{level}") & F.col(f"right_{level}"), F.lit(False))
    left = F.coalesce(F.col("left_2") | ~F.col("left_any"), F.lit(True))
    right = F.coalesce(F.col("right_2") | ~F.col("right_any"), F.lit(True))
    return left & right if level == 3 else left


#: Kinds of items by which reads find transcripts: parts of both with several exons,
#: inner ends of the outer exons, and the outer exons themselves.
EXON, DON, ACC, JOINT, LEFT, RIGHT, FIRST, LAST, ONLY = range(9)
#: Pairs of one site from which the reads that look there are dealt over parts.
WORK = 1 << 24


def _plain(exons: Column) -> Column:
    """Whether exons have two bases or more and follow one another."""
    after = F.zip_with(F.slice(exons, 1, F.size(exons) - 1), F.slice(exons, 2, F.greatest(F.size(exons) - 1, F.lit(0))), lambda x, y: x["end"] < y["start"])
    return F.coalesce((F.size(exons) > 0) & F.forall(exons, lambda x: x["start"] < x["end"]) & F.forall(after, lambda x: x), F.lit(False))


def _items(exons: Column, acceptors: Column) -> Column:
    """kind, place, a and b of what a transcript is looked up by, but for whole outer exons."""
    item = lambda kind, a, b, i=F.lit(0): F.struct(F.lit(kind).alias("kind"), i.alias("place"), a.alias("a"), b.alias("b"))
    site = lambda kind, sites: F.transform(sites, lambda x, i: item(kind, x, x, i))
    parts = F.concat(
        F.transform(exons, lambda x, i: item(EXON, x["start"], x["end"], i)), site(DON, ends(exons)), site(ACC, acceptors),
        F.transform(joints(exons), lambda x, i: item(JOINT, x["don"], x["acc"], i)),
    )
    first, last = F.element_at(exons, 1), F.element_at(exons, -1)
    outer = F.array(item(LEFT, first["end"], first["end"]), item(RIGHT, last["start"], last["start"]))
    return F.when(F.size(exons) > 1, F.concat(parts, outer)).otherwise(outer)


def _outer(exons: Column) -> Column:
    """The outer exons of a read as items."""
    item = lambda kind, x: F.struct(F.lit(kind).alias("kind"), F.lit(0).alias("place"), x["start"].alias("a"), x["end"].alias("b"))
    first, last = F.element_at(exons, 1), F.element_at(exons, -1)
    return F.when(F.size(exons) > 1, F.array(item(FIRST, first), item(LAST, last))).otherwise(F.array(item(ONLY, first)))


def _first_known(shapes: DataFrame, annotation: DataFrame, touched: DataFrame, params: Params) -> DataFrame:
    """shape, first_known: the first transcript that makes a shape known.

    ``touched`` has it for shapes of one exon.  All sites of a known shape of several exons are those of its transcript, so it
    is looked for among the transcripts at that site of the shape that the fewest have.
    """
    site = lambda kind, sites: F.transform(sites, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("site")))
    sites = lambda exons, acceptors: F.concat(site(DON, ends(exons)), site(ACC, acceptors))
    several = annotation.where("size(anno) > 1").select("*", F.explode(sites(F.col("anno"), starts(F.col("anno")))).alias("at"))
    loads = several.groupBy("tid", "at").agg(F.count("*").alias("n"))
    exons = F.col("exons")
    asked = shapes.where("size(exons) > 1").select("shape", "tid", F.explode(sites(exons, starts(exons, first=params.compat))).alias("at")).join(loads, ["tid", "at"], "left")
    rarest = asked.groupBy("shape").agg(F.min(F.struct("n", "at")).alias("pick"), F.bool_and(F.col("n").isNotNull()).alias("all")).where("all")
    picked = kept(shapes.join(rarest.select("shape", "pick.at", "pick.n"), "shape"), "picked")
    load = picked.groupBy("tid", "at").agg(F.sum("n").alias("load")).where(F.col("load") > WORK)
    left, right, keys = picked.drop("n"), several, ["tid", "at"]
    if not load.isEmpty():
        # No more rows than there are WORKs of pairs.
        parts = F.broadcast(load.select("tid", "at", F.ceil(F.col("load") / WORK).cast("int").alias("parts")))
        left = left.join(parts, keys, "left").withColumn("part", F.pmod(F.xxhash64("shape"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        right = right.join(parts, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
        keys = [*keys, "part"]
    columns = ["shape", "exons", "anno", "start", "end", "start_2", "end_2", "rank"]
    found = left.join(right, keys).select(columns)
    known = _with_known(found, params).where("is_known").groupBy("shape").agg(F.min("rank").alias("first_known"))
    alone = shapes.where("size(exons) = 1").select("shape", "tid", exons[0]["start"].alias("a"), exons[0]["end"].alias("b"))
    only = touched.where((F.col("kind") == ONLY) & F.col("low_known").isNotNull()).select("tid", "a", "b", F.col("low_known").alias("first_known"))
    return known.unionByName(alone.join(only, ["tid", "a", "b"]).select("shape", "first_known"))


def _touched(shapes: DataFrame, annotation: DataFrame, params: Params) -> DataFrame:
    """tid, kind, a, b of outer exons of reads, with the first transcripts that have an exon there.

    ``low`` for any of its exons, ``low_first`` for its first, ``low_last`` for its last;
    ``low_known`` for the only exon of both, where they overlap enough.
    Distinct exons of both sides meet.
    """
    asked = shapes.select("tid", F.explode(_outer(F.col("exons"))).alias("x")).select("tid", "x.kind", F.col("x.a").alias("start"), F.col("x.b").alias("end")).distinct()
    placed = annotation.select("tid", "rank", F.size("anno").alias("m"), F.posexplode("anno").alias("i", "y"))
    ends_ = [(F.col("i") == 0).alias("is_first"), (F.col("i") == F.col("m") - 1).alias("is_last")]
    # The overlap join asks for more than a shared end, so exons are widened.
    there = placed.select("tid", (F.col("y.start") - 1).alias("start"), (F.col("y.end") + 1).alias("end"), *ends_, "rank").groupBy("tid", "start", "end", "is_first", "is_last").agg(F.min("rank").alias("rank"))
    met = intervals.overlap_join(kept(asked, "outer-exons"), there, ["tid"])
    # Transcripts that share no more than an end aren't compared.
    touch = (F.col("kind").isin(LAST, ONLY) & F.col("is_first") & (F.col("end") == F.col("start_2") + 1)) | (F.col("kind").isin(FIRST, ONLY) & F.col("is_last") & (F.col("start") == F.col("end_2") - 1))
    lows = [F.min("rank").alias("low"), *(F.min(F.when(F.col(f"is_{x}"), F.col("rank"))).alias(f"low_{x}") for x in ("first", "last"))]
    covers = intervals.overlap_fraction(F.struct("start", "end"), F.struct((F.col("start_2") + 1).alias("start"), (F.col("end_2") - 1).alias("end"))) >= F.lit(params.single_overlap).cast("float")
    lows.append(F.min(F.when((F.col("kind") == ONLY) & F.col("is_first") & F.col("is_last") & covers, F.col("rank"))).alias("low_known"))
    return met.where(~touch).groupBy("tid", "kind", F.col("start").alias("a"), F.col("end").alias("b")).agg(*lows)


def _said_by_items(reads: DataFrame, annotation: DataFrame, params: Params) -> DataFrame:
    """tid, exons and what the transcripts visited say of plain reads of that shape.

    Reads with the same exons are one shape.  Transcripts aren't paired with it: each
    exon, site and junction is looked up in a table of the first and the last transcript that has
    it, which says whether one up to the first that makes the shape known does.
    """
    shapes = kept(reads.groupBy("tid", "exons").agg(F.min("ord").alias("shape"), F.min("start").alias("start"), F.min("end").alias("end")), "shapes")
    distinct = annotation.groupBy("tid", F.col("exons").alias("anno"))
    whole = kept(distinct.agg(F.min("ord").alias("rank"), F.max("ord").alias("last_rank"), F.min("start").alias("start_2"), F.min("end").alias("end_2")), "shapes-of-annotation")
    touched = kept(_touched(shapes, whole, params), "touched")
    first = _first_known(shapes, whole.drop("last_rank"), touched, params)
    known = kept(shapes.join(first, "shape", "left"), "shapes-with-known")
    key = ["tid", "kind", "a", "b"]
    there = whole.select("tid", "rank", "last_rank", F.explode(_items(F.col("anno"), starts(F.col("anno")))).alias("x")).groupBy("tid", "x.kind", "x.a", "x.b")
    index = there.agg(F.min("rank").alias("low"), F.max("last_rank").alias("high")).unionByName(touched.drop("low_known"), allowMissingColumns=True)
    exons = F.col("exons")
    asked = known.select("shape", "tid", "first_known", F.explode(F.concat(_items(exons, starts(exons, first=params.compat)), _outer(exons))).alias("x"))
    found = asked.select("shape", "first_known", "tid", "x.*").join(index, key)
    until = lambda c: F.coalesce(F.col(c) <= F.col("first_known"), F.col(c).isNotNull())
    of = lambda *kinds: F.col("kind").isin(*kinds)
    hits = [F.collect_list(F.when(of(k) & until("low"), F.col("place"))).alias(f"{x}_hits") for x, k in (("exon", EXON), ("don", DON), ("acc", ACC), ("joint", JOINT))]
    flags = {
        "left_1": of(LEFT) & until("low"), "right_1": of(RIGHT) & until("low"),
        "left_2": of(FIRST, ONLY) & until("low_first"), "right_2": of(LAST, ONLY) & until("low_last"),
        "left_any": of(FIRST, ONLY) & until("low"), "right_any": of(LAST, ONLY) & until("low"),
        # Those before the first known transcript, which share a site and aren't known.
        "has_known_site": of(DON, ACC) & F.coalesce(F.col("low") < F.col("first_known"), F.lit(True)),
    }
    said = found.groupBy("shape").agg(F.max(F.when(of(DON, ACC), F.col("high"))).alias("last_shared"), *(F.bool_or(c).alias(name) for name, c in flags.items()), *hits)
    said = known.join(said, "shape", "left").withColumn("known", F.col("first_known").isNotNull()).withColumn("at", F.coalesce("first_known", "last_shared"))
    ref = annotation.select(F.col("ord").alias("at"), F.struct("gene_id", F.col("is_rev").alias("anno_rev"), *_gene_name(annotation)).alias("ref"))
    return said.join(ref, "at", "left").drop("at", "shape", "start", "end", "first_known", "last_shared")


def _said_by_pairs(reads: DataFrame, annotation: DataFrame, params: Params) -> DataFrame:
    """ord and what the transcripts visited say, by pairs with every one that overlaps."""
    seen = visited(compared(overlapping(reads, annotation), params))
    chosen = F.max_by(F.struct("gene_id", "anno_rev", *_gene_name(annotation)), F.when(F.col("is_known") | F.col("shares"), F.col("rank")))
    hits = [F.array_distinct(F.flatten(F.collect_list(f"{x}_hits"))).alias(f"{x}_hits") for x in ("exon", "don", "acc", "joint")]
    ends_ = [F.bool_or(f"{side}_{kind}").alias(f"{side}_{kind}") for side in ("left", "right") for kind in ("1", "2", "any")]
    return seen.groupBy("ord").agg(F.bool_or("is_known").alias("known"), F.bool_or("shares").alias("has_known_site"), chosen.alias("ref"), *ends_, *hits)


def _odd(reads: DataFrame, annotation: DataFrame) -> DataFrame | None:
    """ord of the reads that items don't do for, if there may be any: with exons of one base or
    in each other's way, or beside a transcript that has such."""
    out = []
    strange = annotation.where(~_plain(F.col("exons")))
    if not reads.where(~_plain(F.col("exons"))).isEmpty():
        out.append(reads.where(~_plain(F.col("exons"))).select("ord"))
    if not strange.isEmpty():
        spans = strange.select("tid", "start", "end")
        out.append(intervals.overlap_join(reads.select("ord", "tid", "start", "end"), spans, ["tid"], "left_semi", ["ord"]).select("ord"))
    return kept(reduce(DataFrame.union, out).distinct(), "odd") if out else None


def _with_said(reads: DataFrame, annotation: DataFrame, params: Params) -> DataFrame:
    """``reads`` with what the transcripts say, without their gene."""
    plain = reads.drop("gene_id", *_gene_name(annotation))
    if params.site_distance > 0:
        return plain.join(_said_by_pairs(reads, annotation, params), "ord", "left")
    odd = _odd(reads, annotation)
    by_items = lambda rows: rows.join(_said_by_items(rows, annotation.where(_plain(F.col("exons"))), params), ["tid", "exons"], "left")
    if odd is None:
        return by_items(plain)
    few = kept(plain.join(odd, "ord"), "odd-reads")
    return by_items(plain.join(odd, "ord", "left_anti")).unionByName(few.join(_said_by_pairs(few, annotation, params), "ord", "left"), allowMissingColumns=True)


def classified(reads: DataFrame, annotation: DataFrame, params: Params = Params()) -> DataFrame:
    """``reads`` with their class, reference gene and novel parts.

    known, has_known_site, full and full_1 to full_5; gene_id, gene_name (where
    the annotation has it) and is_rev of the reference transcript (gene null
    and the read's strand where there is none);
    novel_exon, novel_don, novel_acc, novel_junction as arrays of booleans.
    Reads and annotation are written once, as they are looked at several times; then
    so are the classes, and what they were made from is deleted.
    """
    return settled(lambda: _classes(reads, annotation, params), "classified")


def _classes(reads: DataFrame, annotation: DataFrame, params: Params) -> DataFrame:
    reads, annotation = kept(reads, "spans-of-reads"), kept(annotation, "spans-of-annotation")
    names = _gene_name(annotation)
    rows = _with_said(reads, annotation, params)
    novel = lambda items, hits: F.transform(items, lambda _, i: ~F.coalesce(F.array_contains(F.col(hits), i), F.lit(False)))
    exons = F.col("exons")
    out = rows.select(
        *(c for c in reads.columns if c not in ("gene_id", "is_rev", *names)),
        F.coalesce("known", F.lit(False)).alias("known"), F.coalesce("has_known_site", F.lit(False)).alias("has_known_site"),
        F.col("ref.gene_id").alias("gene_id"), *(F.col(f"ref.{c}").alias(c) for c in names), F.coalesce("ref.anno_rev", "is_rev").alias("is_rev"),
        novel(exons, "exon_hits").alias("novel_exon"), novel(ends(exons), "don_hits").alias("novel_don"),
        novel(ends(exons), "acc_hits").alias("novel_acc"), novel(ends(exons), "joint_hits").alias("novel_junction"),
        *(full_length(k).alias(f"full_{k}") for k in LEVELS), full_length(params.full_level).alias("full"),
    )
    return out.withColumn("class", F.when(F.col("known"), "known").when(F.col("has_known_site"), "novel").otherwise("unrecognized"))
