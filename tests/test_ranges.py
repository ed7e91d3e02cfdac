"""Files by ranges against one pass over the whole file."""

from __future__ import annotations

import gzip
import random
import struct

import pytest

from isoframe.sources import bam, bgzf, fastq, ranges, tables


def one_pass(text):
    """Records of FASTA or FASTQ text, character by character."""
    at, out = 0, []
    char = lambda: text[at] if at < len(text) else ""
    while at < len(text) and text[at] not in ">@":
        at += 1
    while at < len(text):
        end = text.find("\n", at) if "\n" in text[at:] else len(text)
        head = text[at + 1 : end].rstrip("\r")
        name = head.split()[0] if head.split() and not head[0].isspace() else ""
        comment, at, seq = head[len(name) :].strip() or None, end + 1, ""
        while char() and char() not in ">+@":
            end = text.find("\n", at) if "\n" in text[at:] else len(text)
            seq, at = seq + text[at:end].rstrip("\r"), end + 1
        if char() != "+":
            out.append((name, comment, seq, None))
            continue
        at, qual = text.index("\n", at) + 1, ""
        while True:
            end = text.find("\n", at) if "\n" in text[at:] else len(text)
            qual, at = qual + text[at:end].rstrip("\r"), end + 1
            if len(qual) >= len(seq) or at >= len(text):
                break
        assert len(qual) == len(seq)
        out.append((name, comment, seq, qual))
        while at < len(text) and text[at] not in ">@":
            at += 1
    return out


def text_of(rng, n):
    lines = []
    for i in range(n):
        size, width = rng.choice([1, 3, 40, 200]), rng.choice([1, 7, 60, 1000])
        seq = "".join(rng.choice("ACGTN") for _ in range(size))
        # Quality values full of characters that begin records or lines.
        qual = "".join(rng.choice("@+>I#") for _ in range(size))
        cut = lambda s: [s[k : k + width] for k in range(0, len(s), width)]  # noqa: E731, B023
        kind = rng.random()
        lines.append((">" if kind < 0.2 else "@") + f"r{i}" + rng.choice(["", " c d", "\tx"]))
        lines += cut(seq) + rng.choice([[], [""]])
        if kind >= 0.2:
            lines += ["+" + rng.choice(["", f"r{i}", "@x"]), *cut(qual)] + rng.choice([[], [], ["", "between"]])
    return rng.choice(["\n", "\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("seed", range(4))
def test_fastq_at_any_cut(seed, tmp_path, monkeypatch):
    """The ranges' ends at many places, without Spark."""
    rng = random.Random(seed)
    for k in range(25):
        text = text_of(rng, rng.choice([1, 4, 25]))
        path = str(tmp_path / f"{k}.fq")
        (tmp_path / f"{k}.fq").write_bytes(text.encode())
        want, size = one_pass(text), len(text)
        for step in {1 if size < 300 else 50, 17, 64, 1000, size}:
            got, place = [], fastq.start(path, ())
            for begin in range(0, size, step):
                end = min(begin + step, size)
                if place >= end:
                    continue
                try:
                    first, stop, n = fastq.scan(path, (), begin, end, None)
                except ValueError:
                    first = -1
                if first != place:
                    first, stop, n = fastq.scan(path, (), begin, end, place)
                some = list(fastq.records(path, (), first, stop))
                assert len(some) == n
                got += some
                place = stop
            assert got == want


def test_fastq_files_of_a_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE", 300)
    rng = random.Random(8)
    texts = [text_of(rng, 30), text_of(rng, 12)]
    for name, text in zip(("a.fq", "b.fastq"), texts, strict=True):
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "c.fq.gz").write_bytes(gzip.compress(texts[1].encode()))
    (tmp_path / "readme.txt").write_text("@no record")
    rows = tables.read_fastq(spark, str(tmp_path)).orderBy("file", "ord").collect()
    got = {f: [(r.name, r.comment, r.seq, r.qual) for r in rows if r.file.endswith(f)] for f in ("a.fq", "b.fastq", "c.fq.gz")}
    assert got == {"a.fq": one_pass(texts[0]), "b.fastq": one_pass(texts[1]), "c.fq.gz": one_pass(texts[1])}
    first = rows[0].ord
    assert [r.ord - first for r in rows if r.file.endswith("a.fq")] == list(range(len(got["a.fq"])))
    assert tables.read_fastq(spark, str(tmp_path / "a.fq")).rdd.getNumPartitions() > 3


def test_a_file_cut_short_is_an_error(spark, tmp_path):
    (tmp_path / "x.fq").write_text("@a\nACGT\n+\nIII\n")
    with pytest.raises(ValueError, match="quality"):
        tables.read_fastq(spark, str(tmp_path / "x.fq"))
    (tmp_path / "y.fq").write_text("")
    assert tables.read_fastq(spark, str(tmp_path / "y.fq")).count() == 0


def bam_content(rng, n):
    """A BAM file's content: short and long records, names and tags like anything."""
    contigs = [(f"c{k}", 10_000) for k in range(rng.choice([1, 3, 300]))]
    out = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(contigs))
    for name, length in contigs:
        out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
    for i in range(n):
        bases, tid = rng.choice([0, 5, 120, 3000]), rng.randrange(-1, len(contigs))
        name, ops = f"r{i}", [(bases or 1, 0), (7, 3), (4, 0)]
        body = struct.pack("<iiBBHHHiiii", tid, rng.randrange(-1, 9000), len(name) + 1, 60, 0, len(ops), 16, bases, -1, -1, 0) + name.encode() + b"\0"
        body += b"".join(struct.pack("<I", k << 4 | op) for k, op in ops) + rng.randbytes((bases + 1) // 2) + bytes(bases) + b"NMi" + struct.pack("<i", i)
        out += struct.pack("<i", len(body)) + body
    return out


@pytest.mark.parametrize("seed", range(3))
def test_bam_at_any_cut(seed, tmp_path, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(bgzf, "CONTENT", rng.choice([90, 700, 5000]))
    path = str(tmp_path / "x.bam")
    (tmp_path / "x.bam").write_bytes(b"".join(bgzf.blocks([bam_content(rng, 60)])))
    want = [x[2:] for x in bam.records(path)]
    assert len(want) == 60
    size, known, gaps, at = (tmp_path / "x.bam").stat().st_size, bam.about(path), [0], 0
    with ranges.opened(path) as stream:
        while at < size:
            _, at = bgzf.block(stream, at)
            gaps.append(at)
    # Cut at every gap of blocks, and anywhere.
    cuts = [gaps, *([0, *sorted(rng.sample(range(1, size), min(k, size - 1))), size] for k in (1, 5, 30))]
    for bounds in cuts:
        got, place = [], known[1]
        for begin, end in zip(bounds, bounds[1:]):
            if place >> 16 >= end:
                continue
            try:
                first, stop, n = bam.scan(path, known, begin, end, None)
            except ValueError:
                first = -1
            if first != place:
                first, stop, n = bam.scan(path, known, begin, end, place)
            some = list(bam._between(path, known, first, stop))
            assert len(some) == n
            got, place = got + some, stop
        assert got == want


def test_bam_by_ranges_and_back(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    (tmp_path / "in").mkdir()
    monkeypatch.setattr(ranges, "RANGE", 1500)
    for k in range(2):
        monkeypatch.setattr(bgzf, "CONTENT", 700)
        (tmp_path / "in" / f"{k}.bam").write_bytes(b"".join(bgzf.blocks([bam_content(rng, 80)])))
    # Gzip blocks that aren't BAM's.
    data = bam_content(rng, 7)
    (tmp_path / "in" / "z.bam").write_bytes(gzip.compress(data[:50]) + gzip.compress(data[50:]))
    rows = bam.read(spark, str(tmp_path / "in"))
    spark.dataSource.register(bam.BamSource)
    plain = spark.read.format("bam").load(str(tmp_path / "in"))
    key = lambda r: (r.file, r.ord)
    assert [tuple(r) for r in sorted(rows.collect(), key=key)] == [tuple(r) for r in sorted(plain.collect(), key=key)]
    assert rows.rdd.getNumPartitions() > 6 and rows.count() == 167
    # Written, by place, and read again.
    contigs = spark.createDataFrame([(f"c{k}", k, 10_000) for k in range(300)], "name string, tid int, length int")
    one = rows.where("file LIKE '%/0.bam'")
    bam.write(one, contigs, str(tmp_path / "out"))
    columns = ["qname", "flag", "chrom", "tid", "pos", "mapq", "cigar", "l_qseq", "nm", "as_score", "nh", "xs"]
    back = bam.read(spark, str(tmp_path / "out")).orderBy("file", "ord").select(columns).collect()
    assert sorted(back, key=str) == sorted(one.select(columns).collect(), key=str)
    places = [(r.tid if r.tid >= 0 else 1 << 30, r.pos) for r in back]
    assert places == sorted(places)
