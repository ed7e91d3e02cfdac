"""Alignment records of BAM files.

``read`` cuts files into ranges of their blocks, so that a large file is read by
many tasks; see ``sources.ranges``.  ``write`` makes a folder of BAM files.
``spark.dataSource.register(BamSource)`` and ``spark.read.format("bam")
.load(path)`` read a file by one task each, of any gzip blocks.
"""

from __future__ import annotations

import glob
import gzip
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from isoframe.sources import bgzf, ranges
from isoframe.sources.ranges import FILE_SPAN

SCHEMA = "file string, ord long, qname string, flag int, chrom string, tid int, pos int, mapq int, cigar string, l_qseq int, nm int, as_score int, nh int, xs string"
#: Operations by code, and bytes of a tag's value by type.
OPERATIONS = "MIDNSHP=XB"
OPERATION = re.compile(r"(\d+)([MIDNSHP=XB])")
WIDTHS = {"A": ("c", 1), "c": ("b", 1), "C": ("B", 1), "s": ("h", 2), "S": ("H", 2), "i": ("i", 4), "I": ("I", 4), "f": ("f", 4)}


class File(InputPartition):
    def __init__(self, path: str, number: int):
        self.path, self.first = path, number * FILE_SPAN


def tags(raw: bytes) -> dict[str, object]:
    """Optional fields; arrays are passed over."""
    out, at = {}, 0
    while at + 3 <= len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            out[name], at = raw[at:end].decode(), end + 1
        elif kind == "B":
            width, (n,) = WIDTHS[chr(raw[at])][1], struct.unpack_from("<i", raw, at + 1)
            at += 5 + width * n
        else:
            code, width = WIDTHS[kind]
            (value,) = struct.unpack_from("<" + code, raw, at)
            out[name], at = value.decode() if kind == "A" else value, at + width
    return out


def header(stream) -> list[tuple[str, int]]:
    """Contig names and lengths; the stream is left at the first record."""
    if stream.read(4) != b"BAM\1":
        raise ValueError("not a BAM stream")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    out = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        name = stream.read(struct.unpack("<i", stream.read(4))[0])[:-1].decode()
        out.append((name, struct.unpack("<i", stream.read(4))[0]))
    return out


@lru_cache(1 << 16)
def _cigar(packed: bytes) -> str:
    return "".join(f"{x >> 4}{OPERATIONS[x & 15]}" for (x,) in struct.iter_unpack("<I", packed)) or "*"


def record(raw: bytes, names: list[str]) -> tuple:
    """The columns after file and ord of one record."""
    tid, pos, l_name, mapq, _, n_cigar, flag, l_seq = struct.unpack_from("<iiBBHHHi", raw)
    at = 32 + l_name
    cigar = _cigar(raw[at : at + 4 * n_cigar])
    found = tags(raw[at + 4 * n_cigar + (l_seq + 1) // 2 + l_seq :])
    return raw[32 : at - 1].decode(), flag, names[tid] if tid >= 0 else None, tid, pos, mapq, cigar, l_seq, found.get("NM"), found.get("AS"), found.get("NH"), found.get("XS")


def records(path: str, first: int = 0) -> Iterator[tuple]:
    """The records of a file, numbered from ``first`` on."""
    with ranges.opened(path) as raw, gzip.open(raw, "rb") as stream:
        names, ord_ = [name for name, _ in header(stream)], first
        while size := stream.read(4):
            yield path, ord_, *record(stream.read(struct.unpack("<i", size)[0]), names)
            ord_ += 1


#: Records that must look like such before a place is taken for the begin of one.
TRIED = 4


def about(path: str) -> tuple[list[str], int] | None:
    """Contig names and the place of the first record; None for a file of other gzip blocks."""
    with ranges.opened(path) as stream:
        try:
            bgzf.block(stream, 0)
        except ValueError:
            return None
    content = bgzf.Content(path, 0)
    names = [name for name, _ in header(content)]
    return names, content.place()


def _raw(content: bgzf.Content) -> bytes | None:
    """The next record, None at the end."""
    size = content.read(4)
    if not size:
        return None
    raw = content.read(n := struct.unpack("<i", size)[0]) if len(size) == 4 else b""
    if len(size) < 4 or len(raw) < n:
        raise ValueError("record cut short")
    return raw


def _looks_right(raw: bytes, contigs: int) -> bool:
    if len(raw) < 33:
        return False
    tid, pos, l_name, _, _, n_cigar, _, l_seq, other, other_pos = struct.unpack_from("<iiBBHHHiii", raw)
    end = 32 + l_name
    return (
        -1 <= tid < contigs and -1 <= other < contigs and pos >= -1 and other_pos >= -1 and l_name > 0 and l_seq >= 0
        and end + 4 * n_cigar + (l_seq + 1) // 2 + l_seq <= len(raw) and raw[end - 1] == 0 and all(33 <= x < 127 for x in raw[32 : end - 1])
        and all(x & 15 < len(OPERATIONS) for x in struct.unpack_from(f"<{n_cigar}I", raw, end))
    )


def _guessed(path: str, contigs: int, begin: int, end: int) -> int:
    """The first place in a range from which records look right, or -1."""
    offset = bgzf.first_block(path, begin, end)
    if offset < 0:
        return -1
    with ranges.opened(path) as stream:
        while offset < end:
            try:
                content, after = bgzf.block(stream, offset)
            except ValueError:
                return -1
            follows = bgzf.Content(path, after << 16).read(36) if content else b""
            seen = content + follows
            for at in range(len(content)):
                if at + 36 > len(seen):
                    break
                size, tid, pos, l_name = struct.unpack_from("<iiiB", seen, at)
                if not (33 <= size < 1 << 28 and -1 <= tid < contigs and pos >= -1 and l_name):
                    continue
                try:
                    records_, good = bgzf.Content(path, offset << 16 | at), 0
                    while good < TRIED and (raw := _raw(records_)) is not None and _looks_right(raw, contigs):
                        good += 1
                    if good == TRIED or (good and raw is None):
                        return offset << 16 | at
                except ValueError:
                    pass
            offset = after
    return -1


def scan(path: str, known: tuple, begin: int, end: int, place: int | None) -> tuple[int, int, int]:
    # A file's first record needs no search.
    first = place if place is not None else known[1] if known[1] >> 16 < end and begin == 0 else _guessed(path, len(known[0]), begin, end)
    if first < 0:
        raise ValueError("no record begins here")
    content, n = bgzf.Content(path, first), 0
    while (stop := content.place()) >> 16 < end and _raw(content) is not None:
        n += 1
    return first, stop, n


def _between(path: str, known: tuple, first: int, stop: int) -> Iterator[tuple]:
    if first < stop:
        content = bgzf.Content(path, first)
        while content.place() < stop and (raw := _raw(content)) is not None:
            yield record(raw, known[0])


FORMAT = ranges.Format(
    (".bam",), SCHEMA.removeprefix("file string, ord long, "), 16, about, lambda path, known: known[1], scan, _between, lambda path: (x[2:] for x in records(path))
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of a file or folder; absent tags are null.  Files of other gzip
    blocks than BAM's are read by one task each."""
    return ranges.read(spark, path, FORMAT)


@lru_cache(1 << 16)
def _operations(cigar: str | None) -> tuple[int, bytes, int]:
    """How many operations a CIGAR string has, their codes, and the bases of the reference that they cover."""
    ops = [] if cigar in (None, "*") else [(int(n), OPERATIONS.index(op)) for n, op in OPERATION.findall(cigar)]
    return len(ops), struct.pack(f"<{len(ops)}I", *(k << 4 | op for k, op in ops)), sum(n for n, op in ops if OPERATIONS[op] in "MDN=X")


def packed(row: tuple, tids: dict[str, int]) -> bytes:
    """A record, of the columns of SCHEMA, without bases: N for each, and no qualities."""
    _, _, qname, flag, chrom, _, pos, mapq, cigar, l_qseq, nm, as_score, nh, xs = row
    n_ops, ops, covered = _operations(cigar)
    name, pos, n = qname.encode() + b"\0", -1 if pos is None else pos, l_qseq or 0
    out = struct.pack("<iiBBHHHiiii", tids.get(chrom, -1), pos, len(name), mapq or 0, _bin(pos, pos + (covered or 1)), n_ops, flag, n, -1, -1, 0)
    out += name + ops + b"\xff" * ((n + 1) // 2 + n)
    for tag, value in ((b"NMi", nm), (b"ASi", as_score), (b"NHi", nh)):
        out += b"" if value is None else tag + struct.pack("<i", value)
    out += b"" if xs is None else b"XSA" + xs.encode()
    return struct.pack("<i", len(out)) + out


def _bin(begin: int, end: int) -> int:
    """Number of the smallest bin that holds a span, as the format numbers them."""
    end -= 1
    for level, shift in enumerate(range(14, 29, 3)):
        if begin >> shift == end >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (begin >> shift)
    return 0


def write(rows: DataFrame, contigs: DataFrame, path: str) -> None:
    """Write records as a folder of BAM files, each with the header, by place.

    Files follow one another by contig and place, unmapped records last.
    ``contigs`` (name, tid, length) is one row for each contig.
    """
    named = [(r["name"], r["length"]) for r in contigs.orderBy("tid").select("name", "length").collect()]
    writer = BamWriter(path, "\n".join(f"{name}\t{length}" for name, length in named))
    last = F.when(F.col("tid") >= 0, F.col("tid")).otherwise(1 << 30)
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    plain = rows.select(*(F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in columns))
    plain = plain.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")))
    ordered = plain.repartitionByRange(last, "pos", "ord").sortWithinPartitions(last, "pos", "ord")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = writer.write(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        yield pa.RecordBatch.from_pydict({"part": [made.part], "made": [made.made]})

    # A row for each file; a task that runs again writes another one.
    made = ordered.mapInArrow(written, "part long, made string").collect()
    writer.commit([Written(r["part"], r["made"]) for r in made])


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BamReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return BamWriter(self.options["path"], self.options["contigs"])


class BamReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        path = self.path
        found = glob.glob(os.path.join(path, "*.bam")) if os.path.isdir(path) else glob.glob(path)
        return [File(x, k) for k, x in enumerate(sorted(found))]

    def read(self, partition: File) -> Iterator[tuple]:
        yield from records(partition.path, partition.first)


class Written(WriterCommitMessage):
    def __init__(self, part: int, made: str):
        self.part, self.made = part, made


class BamWriter(DataSourceWriter):
    """Each task writes a file of its own name, renamed when all are there."""

    def __init__(self, path: str, contigs: str):
        self.path = path.rstrip("/")
        self.contigs = [(name, int(length)) for name, length in (line.split("\t") for line in contigs.splitlines())]

    def _head(self) -> bytes:
        text = "".join(f"@SQ\tSN:{name}\tLN:{length}\n" for name, length in self.contigs).encode()
        out = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(self.contigs))
        for name, length in self.contigs:
            out += struct.pack("<i", len(name) + 1) + name.encode() + b"\0" + struct.pack("<i", length)
        return out

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, folder = ranges._system(self.path)
        system.create_dir(folder, recursive=True)
        made = f"{folder}/.part-{task.partitionId():05d}-{task.taskAttemptId()}"
        tids = {name: k for k, (name, _) in enumerate(self.contigs)}

        def content():
            yield self._head()
            for row in rows:
                yield packed(tuple(row), tids)

        with system.open_output_stream(made) as out:
            for some in bgzf.blocks(content()):
                out.write(some)
        return Written(task.partitionId(), made)

    def commit(self, messages) -> None:
        system, folder = ranges._system(self.path)
        for message in messages:
            system.move(message.made, f"{folder}/part-{message.part:05d}.bam")

    def abort(self, messages) -> None:
        system, _ = ranges._system(self.path)
        for message in messages:
            if message is not None:
                system.delete_file(message.made)
