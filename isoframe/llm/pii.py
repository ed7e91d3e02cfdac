"""Personal data by base patterns and a candidate classifier (operator 4).

The base kinds follow fixed patterns.  Beyond them, generators of high recall
propose overlapping spans; boosted trees on features of a span's format and
its context give each a score, a sigmoid fitted on held-out examples makes it
a probability, and a fixed threshold selects.  Base spans always stay.

No labelled spans exist, so the trees are trained on texts made from a seed:
values of each added kind and look-alikes (dates, versions, prices, order
numbers, identifiers, long words), each in random context.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoframe.llm.quality import _platt

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "local_phone", "national_id", "iban", "spelled_email")
#: A proposed span is selected from this calibrated probability on.
SELECT_AT = 0.9
#: Made examples, and those of them held out for the calibration.
EXAMPLES, HELD_OUT = 12_000, 4_000
ROUNDS, DEPTH, RATE = 40, 3, 0.3

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


_IN_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _emails(text: str) -> Iterator[Span]:
    """A match begins where the run of local characters before its @ does."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _IN_LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at) if begin < at else None
        if m:
            yield "email", begin, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping spans of the base kinds, failing ones dropped."""
    out = list(_emails(text)) if "@" in text else []
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


_KEYWORD = re.compile(r"(?i)(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[ _-]?key|access[ _-]?key|private[ _-]?key)[\"']?\x20{0,2}(?::=|=>|[:=])\x20{0,2}[\"']?([^\s\"'<>]{6,})")
_HINT = re.compile(r"(?i)pass|pwd|token|secret|key")
_BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])(?<!\+[0-9]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SPELLED = re.compile(r"(?i)[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63})+")
_CONTEXT = re.compile(r"(?i)(phone|call|tel|mobile|fax)|(ssn|social|national|passport|id)|(iban|bank|account)|(mail|contact|write)|(pass|pwd|token|secret|key|auth)")


def candidates(text: str) -> Iterator[Span]:
    """Proposed spans of the added kinds; they may overlap."""
    if _HINT.search(text) if any(x in text for x in ("=", ":")) else None:
        for m in _KEYWORD.finditer(text):
            yield "secret", m.start(1), m.end(1)
    for m in _BLOB.finditer(text):
        if any(c.isdigit() for c in m.group()):
            yield "secret", m.start(), m.end()
    for kind, pattern in (("local_phone", _LOCAL_PHONE), ("national_id", _NATIONAL), ("iban", _IBAN)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()
    low = text.lower()
    if "at" in low and "dot" in low:
        for m in _SPELLED.finditer(text):
            yield "spelled_email", m.start(), m.end()


def _mod_97(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    value, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 2]
    n = len(value)
    counts = np.unique(np.array(list(value)), return_counts=True)[1] / n
    digits = sum(c.isdigit() for c in value)
    words = [m.lastindex for m in _CONTEXT.finditer(before)]
    return [
        *(float(kind == k) for k in ADDED_KINDS), float(n), digits / n, sum(c.isupper() for c in value) / n, sum(c in "0123456789abcdefABCDEF" for c in value) / n,
        float(-(counts * np.log2(counts)).sum()), float(sum(not c.isalnum() for c in value)) / n, float(sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))) / n,
        float(kind == "iban" and _mod_97(value)), *(float(i in words) for i in range(1, 6)), float(bool(re.search(r"[:=]\s?[\"']?\Z", before))), float(before[-1:] in "\"'"), float(after[:1] in "\"'"),
        float(value[:3] in ("000", "666") or value[:1] == "9" and kind == "national_id"), float(value.lstrip("(")[:1] in "01" and kind == "local_phone"), float(sum(c in "_/-" for c in value)),
    ]


@dataclass
class Trees:
    """Boosted regression trees on log loss, as nested (feature, cut, low, high)."""

    start: float = 0.0
    trees: list = field(default_factory=list)
    slope: float = 1.0
    offset: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += RATE * _leaf_values(tree, x)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.scores(x) + self.offset, -50, 50)))


def _leaf_values(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    at, cut, low, high = tree
    side = x[:, at] <= cut
    out = np.empty(len(x))
    out[side], out[~side] = _leaf_values(low, x[side]), _leaf_values(high, x[~side])
    return out


def _grown(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int):
    value = float(grad.sum() / (hess.sum() + 1))
    best = (1e-6, None, None)
    if depth and len(x) > 20:
        whole = grad.sum() ** 2 / (hess.sum() + 1)
        for at in range(x.shape[1]):
            for cut in np.unique(np.quantile(x[:, at], np.linspace(0.05, 0.95, 19))):
                side = x[:, at] <= cut
                if side.all():
                    continue
                g, h = grad[side].sum(), hess[side].sum()
                gain = g**2 / (h + 1) + (grad.sum() - g) ** 2 / (hess.sum() - h + 1) - whole
                if gain > best[0]:
                    best = (gain, at, float(cut))
    if best[1] is None:
        return value
    _, at, cut = best
    side = x[:, at] <= cut
    return at, cut, _grown(x[side], grad[side], hess[side], depth - 1), _grown(x[~side], grad[~side], hess[~side], depth - 1)


def _made(rng: np.random.Generator, n: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Texts and the spans in them that are personal data."""
    pick = lambda x: x[int(rng.integers(len(x)))]
    some = lambda letters, n: "".join(pick(letters) for _ in range(n))
    lower, hexes, base = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda: some(lower, int(rng.integers(2, 12)))

    def iban() -> str:
        rest = some("0123456789", int(rng.integers(12, 24)))
        country = pick(["DE", "FR", "ES", "GB", "NL"])
        check = 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97
        return f"{country}{check:02d}{rest}"

    keyed = lambda v: pick(["password=", "Password: ", "token = \"", "secret: ", "api_key=", "pwd=", "access key: ", "token: '"]) + v
    secret = lambda: pick([some(hexes, int(pick([18, 32, 40, 64]))), some(base, int(rng.integers(10, 40))), some(lower, 5) + some("0123456789", 3) + "!", some(base, int(rng.integers(100, 400)))])
    good = [
        lambda: (keyed(v := secret()), v), lambda: (v := some(hexes, int(pick([32, 40, 64]))), v), lambda: (v := some(base, int(pick([rng.integers(24, 48), rng.integers(48, 600)]))) + "1", v),
        lambda: (v := pick(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(pick("23456789") + some("0123456789", 2), some("0123456789", 3), some("0123456789", 4)), v),
        lambda: (v := f"{rng.integers(1, 665):03d}-{rng.integers(1, 99):02d}-{rng.integers(1, 9999):04d}", v), lambda: (v := iban(), v),
        lambda: (v := pick(["{}(at){}(dot){}", "{} at {} dot {}", "{} [at] {} [dot] {}"]).format(word(), word(), pick(["com", "org", "net"])), v),
    ]
    bad = [
        lambda: "token: " + word(), lambda: "the key = " + word() + word(), lambda: "password: " + pick(["required", "protected", "unknown", "forgotten", "changes"]),
        lambda: "-".join(word() for _ in range(5)) + "-2020", lambda: "_".join(word() for _ in range(4)) + "_1", lambda: "/".join(word() for _ in range(5)) + "/2",
        lambda: some("0123456789", int(rng.integers(20, 40))), lambda: "=" * 30, lambda: "a1" * 15, lambda: pick("xAa=") * int(pick([rng.integers(18, 60), rng.integers(60, 600)])) + "1", lambda: "/".join(word() for _ in range(int(rng.integers(10, 80)))) + "/2", lambda: "_" * 30 + "1",
        lambda: f"000-{rng.integers(1, 99):02d}-{rng.integers(1, 9999):04d}", lambda: f"9{rng.integers(0, 99):02d}-{rng.integers(1, 99):02d}-{rng.integers(1, 9999):04d}",
        lambda: f"{pick('01')}{rng.integers(0, 99):02d}.{rng.integers(100, 999)}.{rng.integers(1000, 9999)}", lambda: "AB12 " + " ".join(some(base[:26], 4) for _ in range(3)),
        lambda: f"DE{rng.integers(10, 99)}" + some("0123456789", 16), lambda: f"{word()} at {word()} and the dot {word()}", lambda: word().capitalize() * 4 + "2",
    ]
    for _ in range(n):
        lead = " ".join(word() for _ in range(int(rng.integers(0, 6)))) + pick([" ", "\n", ". "])
        tail = pick([" ", ". ", "\n", ", "]) + " ".join(word() for _ in range(int(rng.integers(0, 6))))
        if rng.random() < 0.5:
            shown, value = pick(good)()
            if shown != value and shown[:7] in ('token =', "token: "):
                tail = pick(['"', "'"]) + tail
            at = len(lead) + shown.rindex(value)
            yield lead + shown + tail, [(at, at + len(value))]
        else:
            yield lead + pick(bad)() + tail, []


@lru_cache(maxsize=1)
def trained() -> Trees:
    """The trees, the same in every process: all chance is seeded."""
    rng = np.random.Generator(np.random.PCG64(424242))
    x, y = [], []
    for text, real in _made(rng, EXAMPLES):
        for span in candidates(text):
            x.append(features(text, span))
            y.append(float(any(a < span[2] and span[1] < b for a, b in real)))
    x, y = np.array(x), np.array(y)
    fit = np.arange(len(x)) < len(x) * (EXAMPLES - HELD_OUT) // EXAMPLES
    model = Trees(float(np.log(y[fit].mean() / (1 - y[fit].mean()))))
    score = np.full(int(fit.sum()), model.start)
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = _grown(x[fit], y[fit] - p, p * (1 - p), DEPTH)
        model.trees.append(tree)
        score += RATE * _leaf_values(tree, x[fit])
    model.slope, model.offset = _platt(model.scores(x[~fit]), y[~fit])
    return model


def added_spans(text: str, base: list[Span], model: Trees) -> list[Span]:
    """Selected candidates, the likeliest first, that overlap no other span."""
    proposed = list(dict.fromkeys(candidates(text)))
    if not proposed:
        return []
    likely = model.probabilities(np.array([features(text, s) for s in proposed]))
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for i in sorted(range(len(proposed)), key=lambda i: (-likely[i], proposed[i][1], -proposed[i][2])):
        kind, start, end = proposed[i]
        if likely[i] < SELECT_AT:
            break
        at = np.searchsorted([a for a, _ in taken], end) - 1 if taken else -1
        if at < 0 or taken[at][1] <= start:
            taken.append((start, end))
            taken.sort()
            out.append((kind, start, end))
    return out


def _joined(spans: list[Span]) -> str:
    order = {k: i for i, k in enumerate(BASE_KINDS + ADDED_KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, n_added long, n_spans long, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """Spans of each row: counts by base kind, digest of base spans, all spans.

    Spans are kind:start:end in code points, end exclusive, by kind and start.
    A null text is empty and has none.  Rows are searched one by one, so
    repeated rows have equal results; a null doc_id stays null.
    """
    # Its size depends on ROUNDS and DEPTH alone.
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.doc_id.astype("object"), batch.text, strict=True):
                text = text or ""
                base = base_spans(text)
                added = added_spans(text, base, shared.value)
                counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                out.append((doc_id, *counts, digest, len(added), len(base) + len(added), _joined(base + added)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(search, FOUND)


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    @F.pandas_udf("string")
    def replace(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if text:
                base = base_spans(text)
                done, parts = 0, []
                for kind, a, b in sorted(base + added_spans(text, base, shared.value), key=lambda s: (s[1], -s[2])):
                    if a >= done:
                        parts += [text[done:a], f"<{kind}>"]
                    done = max(done, b)
                text = "".join(parts) + text[done:]
            out.append(text)
        return pd.Series(out, dtype=object)

    cast: Column = F.col("text").cast("string")
    return docs.select(*(replace(cast).alias("text") if c == "text" else F.col(c) for c in docs.columns))
