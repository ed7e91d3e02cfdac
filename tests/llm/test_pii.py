from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from isoframe.llm import pii


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a1.@+- (0é255")), max_size=50) | st.text(alphabet=st.sampled_from(list("4 0-1")), min_size=14, max_size=40))
def test_base_spans(text):
    assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 300000, "a" * 300000 + "@", "1." * 200000, "+1 " + " " * 300000, "a@" * 100000, "=" * 300000, "password=" * 20000, "A1" * 100000):
        pii.base_spans(text)
        list(pii.candidates(text))
    assert pii.base_spans("1" * 300000 + ".1.1.1") == []


def test_held_out_accuracy():
    model = pii.trained()
    rng = np.random.Generator(np.random.PCG64(99))
    hits = misses = false = right = 0
    for text, real in pii._made(rng, 3000):
        found = pii.added_spans(text, pii.base_spans(text), model)
        for a, b in real:
            caught = any(s < b and a < e for _, s, e in found + pii.base_spans(text))
            hits, misses = hits + caught, misses + (not caught)
        for _, s, e in found:
            ok = any(s < b and a < e for a, b in real)
            right, false = right + ok, false + (not ok)
    assert hits / (hits + misses) > 0.9
    assert right / (right + false) > 0.97


def test_query(spark):
    texts = [None, "", "x@y.zz 1.2.3.4, 4111 1111 1111 1111, +1 (743) 555-3824", 'a token = "c354a4b3fd593d2bb6d57ebf16aa0fdbe941f780" of', "it password=0d82db9a40de89a262 of.", "plain words only", "call (505) 555-1941 now", "é" * 200000 + " a@b.cc"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[2], "s"), (5, texts[5], "s")], "doc_id long, text string, spans string")
    rows = pii.personal_data(docs).collect()
    assert len(rows) == 10
    by = {r.doc_id: r for r in rows}
    for i, t in enumerate(texts):
        base = brute(t or "")
        assert (by[i].n_email, by[i].n_ip, by[i].n_card, by[i].n_phone) == tuple(sum(s[0] == k for s in base) for k in pii.BASE_KINDS)
        assert by[i].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(by[i].spans.split(","))
    assert by[3].spans == "secret:11:51" and by[4].spans == "secret:12:30" and by[6].spans == "local_phone:5:19" and by[5].spans == ""
    out = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert out[4].text == "it password=<secret> of." and out[0].text is None and out[5].text == texts[5] and out[2].text == "<email> <ip>, <card>, <phone>"
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_long_secrets_are_whole():
    model = pii.trained()
    rng = np.random.Generator(np.random.PCG64(7))
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    for n in (150, 201, 500, 3000):
        value = "".join(rng.choice(letters, n)) + "1"
        for text in (f"here token={value} of", f"here {value} of"):
            at = text.index(value)
            assert pii.added_spans(text, [], model) == [("secret", at, at + len(value))]
    assert pii.added_spans("x/" * 300 + "2", [], model) == []


def test_spelled_emails_of_any_case():
    for text in ("name (At) site (Dot) com", "name (aT) site (doT) com", "NAME AT SITE DOT COM"):
        assert ("spelled_email", 0, len(text)) in pii.candidates(text)
