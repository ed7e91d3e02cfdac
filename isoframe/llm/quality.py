"""Quality rules (operator 3): counted signals and a trained classifier.

The classifier is a logistic regression on hashed word and character n-grams,
trained on labelled rows and calibrated on others of them (Platt's sigmoid).
A second one is trained on the label of toxic documents: a few words tell them,
so it sees whether a text has the n-grams that differ most between its classes.
Every whole text is scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from isoframe.llm.textkit import U64, Texts, arrow_slices, code_points_before, mix, runs

#: Labelled rows used at most: to fit the weights, and to calibrate them.
FIT_ROWS, CALIBRATION_ROWS = 3000, 1500
#: Partitions of the labelled rows used.
PARTITIONS = 6
#: Hash buckets of word n-grams, and as many of character n-grams.
BITS = 15
#: A document is kept if the calibrated probability of quality 1 is this or more.
KEEP_AT = 0.5
#: It is rejected if the calibrated probability of toxic 1 is this or more.
TOXIC_AT = 0.3
#: Buckets that the model of toxic documents looks at.
TELLING = 256
#: Base limits.
MIN_WORDS, MOST_REPEATED = 50, 50

_LINE = 0x0A
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_IN_WORD = (np.arange(256) & 0xC0) != 0x80
_IN_WORD[[0x20, *range(0x09, 0x0E)]] = False
_KEY = U64(0x9E3779B97F4A7C15)

SIGNALS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeats(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: whether its document has it twice, and not first there."""
    key = mix(hashes + doc.astype(U64) * _KEY)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    later, shared = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    return shared, later


def signals(texts: Texts) -> pd.DataFrame:
    """The counted signals of each text."""
    by_text = lambda flags, doc: np.bincount(doc[flags], minlength=texts.n)
    within = lambda table: (lambda c: c[texts.text_end] - c[texts.text_start])(texts.count_before(table))
    words = texts.words()
    shared, _ = _repeats(*(lambda h, at: (h, texts.doc[at]))(*(found := runs(words, texts.doc, 3))))
    covered = np.zeros(len(words) + 2, bool)
    for k in range(3):
        covered[found[1][shared] + k] = True
    line_end = np.flatnonzero(texts.buf == _LINE)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    full = np.searchsorted(texts.start, line_end) > np.searchsorted(texts.start, line_start)
    line_start, line_end = line_start[full], line_end[full]
    line_doc = np.searchsorted(texts.text_end, line_start)
    _, later = _repeats(texts.span_hash(line_start, line_end), line_doc)
    return pd.DataFrame({
        "n_words": np.diff(texts.first), "word_chars": within(_IN_WORD), "n_symbols": within(_SYMBOL),
        "n_dup_lines": by_text(later, line_doc), "n_repeat_words": by_text(covered[: len(words)], texts.doc),
    })


def base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def _grams(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of the n-grams of each kind, and the bounds of each text's."""
    shift = U64(64 - BITS)
    words = texts.words()
    pairs, at = runs(words, texts.doc, 2)
    out = [(words >> shift, texts.first), (pairs >> shift, np.searchsorted(at, texts.first))]
    points = np.frombuffer(texts.buf.tobytes().decode().encode("utf-32-le"), np.uint32).astype(U64)
    before = code_points_before(texts.buf)
    starts, ends = before[texts.text_start], before[texts.text_end]
    for n in (3, 4):
        if len(points) >= n:
            h = points[: len(points) - n + 1].copy()
            for k in range(1, n):
                h = h * U64(0x100000001B3) + points[k : len(points) - n + 1 + k]
            h = (h * _KEY) >> shift
        else:
            h = np.empty(0, U64)
        # A text's n-grams end n - 1 before its end; none crosses into the next.
        bounds = np.stack([starts, np.maximum(ends - n + 1, starts)], 1).ravel()
        out.append((h + U64(1 << BITS), bounds))
    return out


def _spans(bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    return (bounds[:-1], bounds[1:]) if len(bounds) == n + 1 else (bounds[0::2], bounds[1::2])


def _features(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse features of each text: shares of its n-grams, by kind."""
    kinds = [(h.astype(np.int64), *_spans(b, texts.n)) for h, b in _grams(texts)]
    for i in range(texts.n):
        total = np.concatenate([h[lo[i] : hi[i]] for h, lo, hi in kinds])
        share = np.concatenate([np.full(hi[i] - lo[i], 1.0 / max(hi[i] - lo[i], 1)) for h, lo, hi in kinds])
        where, back = np.unique(total, return_inverse=True)
        yield where, np.bincount(back, share, len(where)) if len(where) else share


def _margins(models: list[Model], texts: Texts) -> list[np.ndarray]:
    """The margins of each model; the n-grams are taken once."""
    out = [np.full(texts.n, m.bias) for m in models]
    seen: list[list[np.ndarray]] = [[] for _ in models]
    for h, bounds in _grams(texts):
        low, high = _spans(bounds, texts.n)
        low, high = np.minimum(low, len(h)), np.minimum(high, len(h))
        for margin, pairs, m in zip(out, seen, models, strict=True):
            if m.by_presence:
                at = np.flatnonzero(m.weights[h])
                doc = np.searchsorted(high, at, side="right")
                inside = low[np.minimum(doc, texts.n - 1)] <= at
                inside &= doc < texts.n
                pairs.append(doc[inside] * len(m.weights) + h[at[inside]].astype(np.int64))
            else:
                total = np.concatenate([[0.0], np.cumsum(m.weights[h])])
                margin += (total[high] - total[low]) / np.maximum(high - low, 1)
    for margin, pairs, m in zip(out, seen, models, strict=True):
        if m.by_presence:
            doc, place = np.divmod(np.unique(np.concatenate(pairs)), len(m.weights))
            margin += np.bincount(doc, m.weights[place], texts.n)
    return out


@dataclass
class Model:
    """Weights of the n-gram buckets, and the calibration of their sum.

    A bucket counts by its share of the n-grams or, ``by_presence``, once if the
    text has it.  ``toxic`` is the model of the toxic label, None where it can't
    be learned.
    """

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    by_presence: bool = False
    toxic: Model | None = None

    def margins(self, texts: Texts) -> np.ndarray:
        return _margins([self], texts)[0]

    def margins_of_rows(self, places: pa.ListArray, shares: pa.ListArray) -> np.ndarray:
        """The margins of rows of features."""
        one = self.weights[places.values.to_numpy()]
        total = np.concatenate([[0.0], np.cumsum(one if self.by_presence else one * shares.values.to_numpy())])
        ends = places.offsets.to_numpy()
        return self.bias + total[ends[1:]] - total[ends[:-1]]

    def judged(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of quality 1 and of toxic 1, and whether both pass."""
        models = [self] if self.toxic is None else [self, self.toxic]
        good, *rest = (m.probabilities(x) for m, x in zip(models, _margins(models, texts), strict=True))
        toxic = rest[0] if rest else np.zeros(texts.n)
        return good, toxic, (good >= KEEP_AT) & (toxic < TOXIC_AT)

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -50, 50)))


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid that fits held-out margins.

    Newton steps on Platt's smoothed targets, halved until the loss falls.
    """
    good, bad = labels.sum(), len(labels) - labels.sum()
    want = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = float(np.std(margins)) or 1.0
    x = np.stack([margins / scale, np.ones_like(margins)], 1)
    loss = lambda w: (np.logaddexp(0, x @ w) - want * (x @ w)).sum() + 1e-6 * w @ w
    at = np.array([0.0, np.log((good + 1) / (bad + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
        slope = x.T @ (p - want) + 2e-6 * at
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(2), slope)
        rate = 1.0
        while rate > 1e-6 and loss(at - rate * step) > loss(at):
            rate /= 2
        at = at - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return float(at[0] / scale), float(at[1])


def _telling(known: DataFrame) -> np.ndarray:
    """Buckets whose presence differs most between the classes, by chi-square."""
    fit = known.where("fit")
    rows, of_one = fit.agg(F.count("*"), F.sum("label")).head()
    # No more rows than buckets.
    has = fit.select("label", F.explode("places").alias("place")).groupBy("place").agg(F.sum("label"), F.count("*")).collect()
    place, ones, n = np.array([tuple(r) for r in has], float).reshape(-1, 3).T
    want = n * of_one / rows
    score = (ones - want) ** 2 / np.maximum(want * (1 - of_one / rows) * (1 - n / rows), 1e-9)
    score[n == rows] = 0
    return np.sort(place[np.lexsort((place, -score))[:TELLING]].astype(np.int64))


def _lists(batch: pa.RecordBatch) -> tuple[pa.ListArray, pa.ListArray]:
    """The places and shares of a batch, with offsets from 0."""
    return tuple(pa.concat_arrays([batch.column(name).cast(pa.list_(kind))]) for name, kind in (("places", pa.int32()), ("shares", pa.float64())))


def _vectors(known: DataFrame, used: np.ndarray, by_presence: bool) -> DataFrame:
    """label, fit, features: sparse vectors over the buckets used."""
    number = np.full(2 << BITS, -1, np.int32)
    number[used] = np.arange(len(used))
    # Their size depends on BITS alone.
    numbers, size = known.sparkSession.sparkContext.broadcast(number), len(used)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, shares = _lists(batch)
            at, ends = numbers.value[places.values.to_numpy()], places.offsets.to_numpy()
            if by_presence:
                kept = np.concatenate([[0], np.cumsum(at >= 0)])
                at, ends = at[at >= 0], kept[ends]
                values = np.ones(len(at))
            else:
                values = shares.values.to_numpy()
            ends = pa.array(ends, pa.int32())
            n = batch.num_rows
            sparse = [pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, size), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(values, pa.float64()))]
            features = pa.StructArray.from_arrays(sparse, ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fit"), features], ["label", "fit", "features"])

    schema = StructType([StructField("label", DoubleType()), StructField("fit", BooleanType()), StructField("features", VectorUDT())])
    return known.select("label", "fit", "places", "shares").mapInArrow(vectors, schema)


def _fitted(rows: DataFrame, label: str, by_presence: bool = False) -> Model | None:
    """The model of one label; None if a class has no row to fit or calibrate."""
    known = rows.where(F.col(label).isNotNull()).withColumnRenamed(label, "label")
    classes = {(r["fit"], r["label"]) for r in known.select("fit", "label").distinct().collect()}
    if len(classes) < 4:
        return None
    used = _telling(known) if by_presence else np.arange(2 << BITS)
    vectors = _vectors(known.where("fit"), used, by_presence).persist()
    try:
        fitted = LogisticRegression(regParam=0.02, maxIter=60, standardization=True).fit(vectors)
    finally:
        vectors.unpersist()
    model = Model(np.zeros(2 << BITS), float(fitted.intercept), by_presence=by_presence)
    model.weights[used] = np.asarray(fitted.coefficients.toArray())
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.margins_of_rows(*_lists(batch))), batch.column("label")], ["margin", "label"])

    # At most CALIBRATION_ROWS pairs of numbers.
    pairs = np.array([tuple(r) for r in known.where("NOT fit").select("label", "places", "shares").mapInArrow(margins, "margin double, label double").collect()])
    model.slope, model.offset = _platt(pairs[:, 0], pairs[:, 1])
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents, and calibrate on others.

    At most FIT_ROWS + CALIBRATION_ROWS labelled rows are used: those of the
    smallest hashed doc_id.  Rows with a null quality or doc_id aren't, nor is
    a null toxic label.  With no row of some quality, nothing can be learned
    and every probability is 1; with none of some toxic label (or no such
    column), nothing is rejected for it.
    """
    total = FIT_ROWS + CALIBRATION_ROWS
    toxic = (F.col("toxic") > 0).cast("double") if "toxic" in labels.columns else F.lit(None).cast("double")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long"), (F.col("quality") > 0).cast("double").alias("label"), toxic.alias("toxic"))
    chosen = known.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(total)
    share = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(total)) < FIT_ROWS
    # ``chosen`` has at most ``total`` narrow rows.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select(F.col("label").alias("quality"), "toxic", share.alias("fit"), "text")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column("text")):
                found = list(_features(Texts(raw)))
                ends = pa.array(np.cumsum([0, *(len(where) for where, _ in found)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), kind)) for x, kind in zip(zip(*found, strict=True), (pa.int32(), pa.float64()), strict=True)]
                labels = [batch.column(name).slice(a, b - a) for name in ("quality", "toxic", "fit")]
                yield pa.RecordBatch.from_arrays([*labels, *lists], ["quality", "toxic", "fit", "places", "shares"])

    rows = texts.mapInArrow(sparse, "quality double, toxic double, fit boolean, places array<int>, shares array<double>")
    # A bounded sample: few partitions, whatever the table has, keep each
    # iteration's sums of weights few.
    rows = rows.repartition(PARTITIONS).persist()
    try:
        model = _fitted(rows, "quality") or Model(np.zeros(2 << BITS), 0.0, 0.0, 50.0)
        model.toxic = _fitted(rows, "toxic", by_presence=True)
        return model
    finally:
        rows.unpersist()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the signals, base_failed, probability, toxicity and kept of every row.

    A null text is empty: it has no words and fails.  Rows are judged one by
    one, so repeated rows have equal results; a null doc_id stays null.
    """
    # Its size depends on BITS alone.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column("text")):
                texts = Texts(raw)
                out = signals(texts)
                failed = base_failed(out.n_words, out.n_repeat_words).to_numpy()
                good, toxic, passed = shared.value.judged(texts)
                more = {"base_failed": failed, "probability": good, "toxicity": toxic, "kept": ~failed & passed}
                columns = [batch.column("doc_id").slice(a, b - a), *(pa.array(out[c].to_numpy(), pa.int64()) for c in SIGNALS), *map(pa.array, more.values())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *SIGNALS, *more])

    columns = "doc_id long, " + ", ".join(f"{c} long" for c in SIGNALS) + ", base_failed boolean, probability double, toxicity double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, columns)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that pass, with all their columns, whatever their names.

    A null or empty text has no words and goes; repeated rows go or stay
    together, and a null doc_id doesn't matter.  An empty table stays empty.
    """
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw in arrow_slices(batch.column(at)):
                texts = Texts(raw)
                counts = signals(texts)
                passed = shared.value.judged(texts)[2] & ~base_failed(counts.n_words, counts.n_repeat_words).to_numpy()
                yield batch.slice(a, b - a).filter(pa.array(passed))

    # By place, so that no name can clash.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns)))).withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    return plain.mapInArrow(passing, plain.schema).toDF(*docs.columns)
