from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from isoframe.llm import chat, line_chunks


def cut(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    r = [(7 * x + 3 * y) % line_chunks.VALUES for x, y in zip(h, [0, *h])]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if 0 < i < len(lines) - 1 and r[i] < r[i - 1] and r[i] <= r[i + 1]:
            out.append("\n".join(now))
            now = []
    return out + ["\n".join(now)] if now else out


def dedup(docs):
    seen, out = {}, []
    for doc_id, text in sorted({(d, t) for d, t in docs if d is not None and t is not None}):
        for k, c in enumerate(cut(text)):
            if "\n" in c:
                seen[c] = min(seen.get(c, (doc_id, k)), (doc_id, k))
    for doc_id, text in docs:
        if doc_id is None or text is None:
            out.append((doc_id, text))
        else:
            out.append((doc_id, "\n".join(c for k, c in enumerate(cut(text)) if "\n" not in c or seen[c] == (doc_id, k))))
    return out


def test_line_chunks(spark):
    rng = random.Random(2)
    passage = [f"shared line {i} \\ é" for i in range(30)]
    docs = []
    for i in range(60):
        lines = [rng.choice(["", " ", f"own {i} {rng.random()}", "\tx", "common"]) for _ in range(rng.randrange(0, 25))]
        at = rng.randrange(len(lines) + 1)
        if i % 2:
            lines[at:at] = passage
        docs.append((i, "\n".join(lines)))
    docs += [(70, None), (None, "\n".join(passage)), (71, ""), (72, "\n" * 3000), (73, "\n".join(passage)), (73, "\n".join(passage)), (5, docs[7][1])]
    frame = spark.createDataFrame([(d, t, "c", 1, d) for d, t in docs], "doc_id long, text string, __doc_id string, n_chunks int, removed long")
    got = line_chunks.without_repeated_chunks(frame)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(dedup(docs), key=key)
    assert got.agg(F.sum("n_removed")).head()[0] > 100
    assert line_chunks.without_repeated_chunks(frame.limit(0)).count() == 0
    # Line ends put in before a passage shift none of its chunks but the first.
    a, b = cut("\n".join(passage)), cut("\n\nmore\n" + "\n".join(passage))
    assert set(a[2:]) <= set(b)


def test_repeated_passages_go_in_other_contexts(spark):
    """Share of the lines of a passage that its second copy loses."""
    rng = random.Random(6)
    line = lambda: f"line {rng.random()}"
    docs, sizes = [], {}
    for n in (5, 8, 12, 20):
        for _ in range(60):
            passage = [line() for _ in range(n)]
            for k in (0, 1):
                docs.append((len(docs), "\n".join([line() for _ in range(15)] + passage + [line() for _ in range(15)])))
            sizes[len(docs) - 1] = n
    got = {r.doc_id: 30 + sizes[r.doc_id] - r.text.count("\n") - 1 for r in line_chunks.without_repeated_chunks(spark.createDataFrame(docs, "doc_id long, text string")).collect() if r.doc_id in sizes}
    share = {n: sum(got[d] for d in sizes if sizes[d] == n) / 60 / n for n in (5, 8, 12, 20)}
    touched = {n: sum(got[d] > 0 for d in sizes if sizes[d] == n) / 60 for n in (5, 8, 12, 20)}
    assert share[5] > 0.1 and share[8] > 0.4 and share[12] > 0.55 and share[20] > 0.7
    assert touched[8] > 0.75 and touched[12] > 0.95


def test_chunks_hold_all_lines(spark):
    for text in ("", "\n", "a\n\nb\n", " a\n  b\n\n\n c", "x"):
        row = spark.range(1).select(line_chunks._text(line_chunks.chunks(F.lit(text))).alias("t"), line_chunks.chunks(F.lit(text)).alias("c")).head()
        assert row.t == text
        assert ["\n".join(x[1:] for x in c.split("\n")) for c in row.c] == cut(text)


def conversation_rows(rng, n):
    odd = ["</s>", "<s>user\n", "[INST]", "\\", "<\\", "[\\n", "\\\\<", "<<SYS>>", "\n", "x y", "é\U0001f642", ""]
    rows = []
    for c in range(n):
        kind = rng.randrange(4)
        if kind:
            rows.append((c, 0, "system", "sys " * rng.choice([1, 50, 900]) if rng.random() < 0.8 else None))
        for t in range(1, rng.randrange(1, 40) if kind != 2 else 1):
            rows.append((c, t, rng.choice(["user", "assistant", "assistant", "system", None, "odd\n<role[n"]), "".join(rng.choice(odd) for _ in range(rng.randrange(5))) + "w " * rng.choice([0, 3, 40, 200, 500, 1500])))
    return rows


def test_chat(spark):
    rng = random.Random(4)
    rows = conversation_rows(rng, 40) + [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (99, None, "assistant", None), (98, 1, "assistant", "same"), (98, 1, "assistant", "same")]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "conv_id long, turn long, role string, text string, window int, pos string")
    formatted = chat.windows(frame)
    said = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        said.setdefault(c, []).append((role or "", text or ""))
    got, targets, sizes = {}, {}, {}
    for r in sorted(chat.read_back(formatted).collect(), key=lambda r: r.window):
        got.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)
        targets.setdefault(r.conv_id, []).extend(r.targets)
    assert got == said
    assert targets == {c: [t for role, t in turns if role == "assistant"] for c, turns in said.items()}
    tokens = lambda segment: len(re.findall(chat.TOKEN, segment)) + chat.MARKS
    for r in sorted(formatted.collect(), key=lambda r: r.window):
        sizes.setdefault(r.conv_id, []).append(r)
    for c, windows in sizes.items():
        turns, at = [(role, tokens(text)) for role, text in said[c]], 0
        head = turns[0][1] if turns[0][0] == "system" else None
        for r, after in zip(windows, [*windows[1:], None]):
            n = r.formatted.count("</s>\n") - r.n_repeated
            new = [x for _, x in turns[at : at + n]]
            # Beyond the budget with a single turn only, which alone is beyond it.
            assert r.n_tokens <= chat.BUDGET or (r.n_tokens == new[0] and n == 1)
            assert after is None or r.n_tokens + turns[at + n][1] > chat.BUDGET
            if at and head is not None:
                first = windows[0].formatted.split("</s>\n")[0] + "</s>\n"
                assert r.formatted.startswith(first) == (head + new[0] <= chat.BUDGET)
            at += n
    assert max(len(v) for v in sizes.values()) > 3 and any(r.n_repeated == 3 for v in sizes.values() for r in v)
    digests = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for c, turns in said.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (digests[c].loss_sha256, digests[c].loss_chars, digests[c].n_turns) == (hashlib.sha256(loss.encode()).hexdigest(), len(loss), len(turns))
        assert digests[c].formatted_chars == sum(len(r.formatted) for r in sizes[c])
    assert chat.digests(chat.windows(frame.limit(0))).count() == 0


def test_windows_share_their_budget_with_a_long_system_turn(spark):
    rows = [(1, 0, "system", "s " * 900)] + [(1, t, "user", "u " * 100) for t in range(1, 8)] + [(2, t, "user", "u " * 100) for t in range(30)] + [(3, 0, "system", "s " * 900), (3, 1, "user", "u " * 500), (3, 2, "user", "u " * 2000)]
    got = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "window").collect()
    assert [(r.n_tokens, r.n_repeated) for r in got if r.conv_id == 1] == [(1008, 0)] + [(1008, 1)] * 6
    assert all(r.n_tokens == 936 for r in got if r.conv_id == 2 and r.window < 3)
    assert [(r.n_tokens, r.n_repeated) for r in got if r.conv_id == 3] == [(904, 0), (504, 0), (2004, 0)]
