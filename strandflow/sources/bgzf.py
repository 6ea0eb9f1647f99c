"""Blocked gzip: members of at most 64 KiB that state their own size, so that a file can be read from any of them.

A virtual offset is a block's place in the file and a place in its text: block << 16 | within.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

# Fixed values of the format: a member's header up to its size, and the empty member that ends a file.
HEAD = struct.Struct("<4BI2BH2BHH")
OPENING = (31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2)
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
#: Text of one block, at most, and the largest block.
TEXT, LARGEST = 0xFF00, 1 << 16


def filesystem(path: str):
    """(file system, path in it) for a local path or an address that pyarrow knows (file, hdfs, s3, gs, ...)."""
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def block(text: bytes) -> bytes:
    """One member that holds text."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(text) + deflate.flush()
    size = HEAD.size + len(body) + 8
    if size > LARGEST:  # text that deflate cannot shrink is stored
        deflate = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = deflate.compress(text) + deflate.flush()
        size = HEAD.size + len(body) + 8
    return HEAD.pack(31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, size - 1) + body + struct.pack("<II", zlib.crc32(text), len(text))


def size_at(data: bytes, at: int) -> int | None:
    """Size of the block whose header stands at a place of data; None if none does."""
    if at + HEAD.size > len(data):
        return None
    *opening, size = HEAD.unpack_from(data, at)
    opening[4] = 0  # time of writing
    opening[5] = 0  # hints of the compressor
    opening[6] = 255  # operating system
    return size + 1 if tuple(opening) == OPENING else None


class Blocks:
    """Random access to the blocks of a file that has read_at(size, place)."""

    def __init__(self, file, ahead: int = 1 << 20):
        self.file, self.size, self.ahead, self.start, self.held = file, file.size(), ahead, 0, b""

    def _bytes(self, at: int, n: int) -> bytes:
        if not (self.start <= at and at + n <= self.start + len(self.held)):
            self.start, self.held = at, self.file.read_at(min(max(n, self.ahead), self.size - at), at)
        return self.held[at - self.start : at - self.start + n]

    def text(self, at: int) -> tuple[bytes, int]:
        """Text of the block at a place, and the place of the next one."""
        size = size_at(self._bytes(at, min(HEAD.size, self.size - at)), 0)
        if size is None or at + size > self.size:
            raise ValueError(f"no block at {at}")
        data = self._bytes(at, size)
        text = zlib.decompress(data[HEAD.size : -8], -15)
        if zlib.crc32(text) != struct.unpack("<I", data[-8:-4])[0]:
            raise ValueError(f"damaged block at {at}")
        return text, at + size

    def first_from(self, at: int) -> int | None:
        """The first block that starts at a place or after it. What only looks like a header does not count: blocks follow on each other to the end, or five do."""
        while at < self.size:
            window = self._bytes(at, min(2 * LARGEST, self.size - at))
            found = window.find(b"\x1f\x8b\x08\x04")
            if found < 0:
                at += max(1, len(window) - 3)
                continue
            if self._followed(at + found):
                return at + found
            at += found + 1
        return None

    def _followed(self, at: int, links: int = 5) -> bool:
        for _ in range(links):
            if at == self.size:
                return True
            size = size_at(self._bytes(at, min(HEAD.size, self.size - at)), 0)
            if size is None or at + size > self.size:
                return False
            at += size
        return True

    def lines(self, start: int, stop: int, exact: bool, stop_exact: bool) -> Iterator[tuple[int, bytes]]:
        """(virtual offset, line) of a part of the file.

        start and stop are virtual offsets of records if exact, else places of bytes: then a part holds the lines that begin
        after the first text of its blocks, up to the one that begins with the first text of the next part's, so that parts
        with common bounds hold every line once. A part that starts at 0 has its first line too.
        """
        skip = not exact and start > 0
        at = start >> 16 if exact else self.first_from(start) if start else 0
        within = start & 0xFFFF if exact else 0
        if at is None or (not stop_exact and at >= stop):
            return
        held, began = b"", None  # a line that goes on, and where it began
        while at < self.size:
            past = not stop_exact and at >= stop
            text, following = self.text(at)
            place = within
            while place < len(text):
                cut = text.find(b"\n", place)
                if began is None:
                    began = at << 16 | place
                    if (stop_exact and began >= stop) or (past and place > 0):
                        return
                if cut < 0:
                    held += text[place:]
                    break
                line, held = held + text[place:cut], b""
                if not skip:
                    yield began, line
                skip, began, place = False, None, cut + 1
                if past:  # this line was the last that the next part leaves to this one
                    return
            at, within = following, 0
        if held and not skip:
            yield began, held


class Writer:
    """Blocks into a stream; tell() is the virtual offset of what comes next."""

    def __init__(self, sink):
        self.sink, self.at, self.text = sink, 0, bytearray()

    def tell(self) -> int:
        return self.at << 16 | len(self.text)

    def write(self, data: bytes) -> None:
        self.text += data
        while len(self.text) >= TEXT:
            self._flush(TEXT)

    def _flush(self, n: int) -> None:
        made = block(bytes(self.text[:n]))
        self.sink.write(made)
        self.at += len(made)
        del self.text[:n]

    def close(self) -> None:
        if self.text:
            self._flush(len(self.text))
        self.sink.write(END)
