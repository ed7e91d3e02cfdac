"""Blocks of BGZF files and places of records in them."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from isoframe.sources import ranges

#: Fixed values of the format: how a block begins, and the empty block at the end.
MAGIC = b"\x1f\x8b\x08\x04"
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Bytes of a block, and of content that is put into one.
LONGEST, CONTENT = 1 << 16, 0xFF00


def block(stream, offset: int) -> tuple[bytes, int]:
    """Content of the block at an offset, and where the next one begins."""
    stream.seek(offset)
    head = stream.read(12)
    if len(head) < 12 or head[:4] != MAGIC:
        raise ValueError(f"no block at byte {offset}")
    extra = stream.read(struct.unpack_from("<H", head, 10)[0])
    size, at = 0, 0
    while at + 4 <= len(extra):
        length = struct.unpack_from("<H", extra, at + 2)[0]
        if extra[at : at + 2] == b"BC" and length == 2 and at + 6 <= len(extra):
            size = struct.unpack_from("<H", extra, at + 4)[0] + 1
        at += 4 + length
    if size < len(head) + len(extra) + 8:
        raise ValueError(f"no block at byte {offset}")
    body = stream.read(size - len(head) - len(extra))
    if len(body) < size - len(head) - len(extra):
        raise ValueError(f"block cut short at byte {offset}")
    try:
        content = zlib.decompress(body[:-8], -15)
    except zlib.error as error:
        raise ValueError(f"no block at byte {offset}") from error
    if struct.unpack("<II", body[-8:]) != (zlib.crc32(content), len(content)):
        raise ValueError(f"wrong sum of block at byte {offset}")
    return content, offset + size


def packed(content: bytes) -> bytes:
    """One block of up to CONTENT bytes."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(content) + deflate.flush()
    size = 18 + len(body) + 8
    return MAGIC + bytes.fromhex("0000000000ff060042430200") + struct.pack("<H", size - 1) + body + struct.pack("<II", zlib.crc32(content), len(content))


def first_block(path: str, begin: int, end: int) -> int:
    """Offset of the first block in a range, or -1."""
    with ranges.opened(path) as stream:
        at = begin
        while at < end:
            stream.seek(at)
            window = stream.read(1 << 20)
            if len(window) < 4:
                break
            found = window.find(MAGIC)
            while found >= 0 and at + found < end:
                try:
                    block(stream, at + found)
                    return at + found
                except ValueError:
                    found = window.find(MAGIC, found + 1)
            at += len(window) - 3
    return -1


class Content:
    """The content of a file from a place on, with the place of each byte.

    A place is a block's offset, times 2^16, plus the byte within its content.
    """

    def __init__(self, path: str, place: int):
        self.stream = ranges.opened(path)
        self.offset, self.at, self.content = place >> 16, place & 0xFFFF, b""
        self.next = self.offset
        self._load(self.at)

    def _load(self, at: int) -> None:
        self.offset, self.at = self.next, at
        try:
            self.content, self.next = block(self.stream, self.offset)
        except ValueError:
            # The end of the file is no block; anything else is an error.
            self.stream.seek(self.offset)
            if self.stream.read(1):
                raise
            self.content = b""

    def place(self) -> int:
        """Place of the next byte; at a block's end, that of the next block."""
        while self.at >= len(self.content) and self.next > self.offset:
            self._load(0)
            if not self.content and self.next == self.offset:
                break
        return self.offset << 16 | self.at

    def read(self, n: int) -> bytes:
        out = b""
        while len(out) < n:
            self.place()
            some = self.content[self.at : self.at + n - len(out)]
            if not some:
                break
            self.at += len(some)
            out += some
        return out


def blocks(content: Iterator[bytes]) -> Iterator[bytes]:
    """Blocks of a stream of content, the empty last one included."""
    held = b""
    for some in content:
        held += some
        while len(held) >= CONTENT:
            yield packed(held[:CONTENT])
            held = held[CONTENT:]
    if held:
        yield packed(held)
    yield END
