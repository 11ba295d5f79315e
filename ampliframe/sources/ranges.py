"""Byte ranges of files in any file system Arrow opens, and blocked gzip.

A blocked gzip file is a series of gzip members of at most 64 KiB that tell their own size, so
reading can start at any of them. Where one begins within a byte range is found in the range itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.datasource import InputPartition

READ_BYTES = 4 << 20
#: bytes that one task reads in ranges shorter than that, and those that opening a range counts as
TASK_BYTES = 32 << 20
OPEN_BYTES = 1 << 16
#: Fixed values of the format: first bytes of a block, and the most data and bytes one can have.
BLOCK_MAGIC = b"\x1f\x8b\x08\x04"
BLOCK_DATA = 65_280
BLOCK_LIMIT = 1 << 16
#: Fixed value: the empty block that ends a file.
LAST_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")

# a piece of data and the coordinate of its first byte
Piece = tuple[bytes, int]


def plain_name(path: str) -> str:
    """One spelling of local paths; other schemes keep theirs."""
    return re.sub(r"^file:/+", "/", path)


def open_filesystem(path: str):
    """The file system of a path or URI and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", plain_name(path)))


def files_below(paths: Sequence[str], suffixes: tuple[str, ...]) -> Iterator[tuple[str, int]]:
    """(path, size) of the files given, and of those below given folders that have a suffix.

    Names keep the scheme, host and account of the path they were found by; each comes once.
    """
    from pyarrow import fs

    seen = set()
    for path in map(plain_name, paths):
        filesystem, inner = open_filesystem(path)
        info = filesystem.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise ValueError(f"no such path: {path}")
        found = [(path, info.size)]
        if info.type == fs.FileType.Directory:
            below = filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
            found = [
                (path.rstrip("/") + item.path[len(inner.rstrip("/")) :], item.size)
                for item in sorted(below, key=lambda i: i.path)
                if item.type == fs.FileType.File and item.path.endswith(suffixes)
            ]
        for name, size in found:
            if name not in seen:
                seen.add(name)
                yield name, size


class ByteRange(InputPartition):
    """Bytes `start` to `end` of a file of `size` bytes."""

    def __init__(self, path: str, start: int, end: int, size: int):
        self.path, self.start, self.end, self.size = path, start, end, size


def byte_ranges(files: Iterator[tuple[str, int]], split: int) -> list[ByteRange]:
    return [
        ByteRange(path, start, min(start + split, size), size)
        for path, size in files
        for start in range(0, size, split)
    ]


class RangeGroup(InputPartition):
    """Byte ranges that one task reads one after the other."""

    def __init__(self, ranges: Sequence[ByteRange]):
        self.ranges = ranges


def range_groups(ranges: Sequence[ByteRange], tasks: int | None) -> list[RangeGroup]:
    """Neighbouring ranges put together, so that short ones do not cost a task each.

    There are `tasks` groups at least, as far as there are ranges, and more where one would have
    over TASK_BYTES; without `tasks` every range stands alone. Ranges stay as they are, so rows and
    what a task holds at once do too.
    """
    total = sum(r.end - r.start + OPEN_BYTES for r in ranges)
    share = total / max(tasks, total / TASK_BYTES) if tasks and total else 0
    groups, held = [], 0
    for r in ranges:
        size = r.end - r.start + OPEN_BYTES
        if not groups or held + size > share:
            groups.append([])
            held = 0
        groups[-1].append(r)
        held += size
    return [RangeGroup(g) for g in groups] or [RangeGroup([])]


def wanted_tasks(spark: SparkSession) -> int:
    """Four tasks a core, so that a slow one does not hold up the rest."""
    return 4 * spark.sparkContext.defaultParallelism


def plain_pieces(raw, start: int, end: int) -> Iterator[Piece]:
    raw.seek(start)
    while block := raw.read(_read_size(start, end)):
        yield block, start
        start += len(block)


def _read_size(at: int, end: int | None) -> int:
    """Bytes to read at a place of a range; behind its end few are wanted."""
    if end is None:
        return READ_BYTES
    return min(READ_BYTES, end - at) if at < end else BLOCK_LIMIT


def gzip_pieces(raw) -> Iterator[Piece]:
    """Data of a gzip file that may consist of several members; coordinates count data bytes."""
    inflater, position, pending = zlib.decompressobj(wbits=31), 0, b""
    raw.seek(0)
    while True:
        if not pending:
            pending = raw.read(READ_BYTES)
            if not pending:
                if not inflater.eof:
                    raise ValueError("gzip stream ends early")
                return
        if inflater.eof:
            if not pending.strip(b"\0"):
                pending = b""
                continue
            inflater = zlib.decompressobj(wbits=31)
        out = inflater.decompress(pending, READ_BYTES)
        pending = inflater.unconsumed_tail or inflater.unused_data
        if out:
            yield out, position
            position += len(out)


def block_bytes(data: bytes, at: int = 0) -> int | None:
    """The size of the block whose header is at `at`; None if there is none or it is cut off."""
    if data[at : at + 4] != BLOCK_MAGIC or len(data) < at + 12:
        return None
    field = at + 12
    end = field + int.from_bytes(data[at + 10 : at + 12], "little")
    while field + 4 <= min(end, len(data)):
        size = int.from_bytes(data[field + 2 : field + 4], "little")
        if data[field : field + 2] == b"BC" and size == 2 and field + 6 <= len(data):
            return int.from_bytes(data[field + 4 : field + 6], "little") + 1
        field += 4 + size
    return None


def is_blocked(raw) -> bool:
    raw.seek(0)
    return block_bytes(raw.read(1024)) is not None


def first_block(raw, start: int, size: int) -> int | None:
    """Where the first block at or after `start` begins, None if there is none.

    What looks like a header counts if one more block, or the end of the file, follows it.
    """
    if start == 0:
        return 0
    raw.seek(start)
    window = raw.read(3 * BLOCK_LIMIT)
    at = window.find(BLOCK_MAGIC)
    while at >= 0:
        length = block_bytes(window, at)
        if length:
            after = at + length
            if start + after == size or block_bytes(window, after):
                return start + at
        at = window.find(BLOCK_MAGIC, at + 1)
    return None


def blocks(raw, at: int, end: int | None = None) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of every block from the one at `at` on; little is read ahead behind `end`."""
    raw.seek(at)
    held = b""
    while True:
        more = raw.read(_read_size(at + len(held), end))
        held += more
        done = 0
        while length := block_bytes(held, done):
            if done + length > len(held):
                break
            yield at + done, held[done : done + length]
            done += length
        held, at = held[done:], at + done
        if not more:
            if held.strip(b"\0"):
                raise ValueError(f"blocked gzip ends early or is broken at byte {at}")
            return


def blocked_pieces(raw, at: int, end: int) -> Iterator[Piece]:
    """Data of the blocks from `at` on; a coordinate is 2^16 times the block's offset plus the place in it."""
    for offset, member in blocks(raw, at, end):
        data = zlib.decompress(member, wbits=31)
        if data:
            yield data, offset << 16


def pieces_of(raw, own: ByteRange) -> tuple[Iterator[Piece], bool, int | None] | None:
    """The data of a range and what follows, whether it is a file's start, and the range's end.

    The end is a coordinate, None for a file that is read by one task. A range has no data of its
    own (None) where a file can only be read from its start or no block begins.
    """
    if not own.path.endswith(".gz"):
        return plain_pieces(raw, own.start, own.end), own.start == 0, own.end
    if not is_blocked(raw):
        return (gzip_pieces(raw), True, None) if own.start == 0 else None
    at = first_block(raw, own.start, own.size)
    if at is None or at >= own.end:
        return None
    return blocked_pieces(raw, at, own.end), at == 0, own.end << 16


def packed_block(data: bytes, level: int) -> bytes:
    """A block of blocked gzip holding at most BLOCK_DATA bytes."""
    deflater = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflater.compress(data) + deflater.flush()
    if len(body) + 26 > BLOCK_LIMIT:
        deflater = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = deflater.compress(data) + deflater.flush()
    head = LAST_BLOCK[:16] + (len(body) + 25).to_bytes(2, "little")
    return head + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")
