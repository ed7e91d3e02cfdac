"""Sequence records of FASTA and FASTQ files, over any number of lines."""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession

from isoframe.sources import ranges

SCHEMA = "name string, comment string, seq string, qual string"
BLANK = re.compile(rb"\s")
#: Records that must read well before a place is taken for the begin of one.
TRIED = 3


def parsed(stream: io.BufferedIOBase, at: int) -> Iterator[tuple[int, int, tuple]]:
    """Place of each record, place of the next, and its columns.

    The stream stands at ``at``, a header's ``@`` or ``>``.  Bases go on until a line begins
    with ``+``, ``@`` or ``>``; after ``+`` as many quality values follow as there are
    bases, whatever the lines begin with, and the next header is the next ``@``
    or ``>``.  At the end the place of the next is where the file ends.
    """
    line = stream.readline()
    here = at + len(line)
    while line:
        name, *comment = BLANK.split(line[1:].rstrip(b"\r\n"), maxsplit=1)
        bases: list[bytes] = []
        while (line := stream.readline()) and line[:1] not in (b"+", b"@", b">"):
            here += len(line)
            bases.append(line.rstrip(b"\r\n"))
        seq, qual = b"".join(bases), None
        next_ = here
        here += len(line)
        if line[:1] == b"+":
            if not line.endswith(b"\n"):
                raise ValueError(f"no quality values at byte {at}")
            size, values = 0, []
            while value := stream.readline():
                here += len(value)
                values.append(value.rstrip(b"\r\n"))
                size += len(values[-1])
                if size >= len(seq):
                    break
            if size != len(seq):
                raise ValueError(f"{size} quality values for {len(seq)} bases at byte {at}")
            qual = b"".join(values)
            # Up to the next header, wherever in a line it begins.
            while True:
                next_, line = here, stream.readline()
                here += len(line)
                heads = [k for k in (line.find(b"@"), line.find(b">")) if k >= 0]
                if heads or not line:
                    break
            if heads:
                next_, line = next_ + min(heads), line[min(heads) :]
        row = (name.decode(), b"".join(comment).strip().decode() or None, seq.decode(), None if qual is None else qual.decode())
        yield at, next_, row
        at = next_


def start(path: str, about) -> int:
    """Place of the first header."""
    with ranges.opened(path) as stream:
        at = 0
        while line := stream.readline():
            heads = [k for k in (line.find(b"@"), line.find(b">")) if k >= 0]
            if heads:
                return at + min(heads)
            at += len(line)
        return at


def _guessed(path: str, begin: int, end: int) -> int:
    """Place of the first line from which records read well, or -1."""
    with ranges.opened(path) as lines, ranges.opened(path) as stream:
        lines.seek(max(begin - 1, 0))
        if begin:
            lines.readline()
        at = lines.tell()
        while at < end and (line := lines.readline()):
            if line[:1] in (b"@", b">"):
                stream.seek(at)
                try:
                    # A record without bases or with a quality line for its name's line is no record.
                    if all(row[2] for _, _, row in islice(parsed(stream, at), TRIED)):
                        return at
                except (ValueError, UnicodeDecodeError):
                    pass
            at += len(line)
    return -1


def scan(path: str, about, begin: int, end: int, place: int | None) -> tuple[int, int, int]:
    first = _guessed(path, begin, end) if place is None else place
    if first < 0:
        raise ValueError("no record begins here")
    n, stop = 0, first
    with ranges.opened(path) as stream:
        stream.seek(first)
        for _, stop, _ in parsed(stream, first):
            n += 1
            if stop >= end:
                break
    return first, stop, n


def records(path: str, about, first: int, stop: int) -> Iterator[tuple]:
    with ranges.opened(path) as stream:
        stream.seek(first)
        for at, _, row in parsed(stream, first) if first < stop else ():
            if at >= stop:
                break
            yield row


def _whole(path: str) -> Iterator[tuple]:
    """Records of a compressed file, which has no places to begin at."""
    with ranges.opened(path) as raw, gzip.open(raw, "rb") as stream:
        buffered = io.BufferedReader(stream)
        while line := buffered.peek(1)[:1]:
            if line in (b"@", b">"):
                break
            buffered.read(1)
        for _, _, row in parsed(buffered, 0):
            yield row


FORMAT = ranges.Format((".fq", ".fastq", ".fa", ".fasta", ".gz"), SCHEMA, 0, lambda path: None if path.endswith(".gz") else (), start, scan, records, _whole)


def read(spark: SparkSession, path: str) -> DataFrame:
    """file, ord, name, comment, seq, qual of the records of a file or folder.

    ``qual`` is null for FASTA records.  A file is read by as many tasks as it
    has ranges; a gzip file, which can't be entered, by one.  A record whose
    quality values are not as many as its bases is an error.
    """
    return ranges.read(spark, path, FORMAT)
