"""FASTQ data source and sink.

The source reads plain and blocked gzip files by byte ranges, in any number of tasks, other gzip
files by one task each. A range owns the records whose header follows a newline of its own. Lines
are found by their newlines, a few megabytes at once; columns that are not asked for, and reads
that a pushed filter on length or mean quality refuses, are never made.

The sink writes plain or blocked gzip files, one folder for each value of some columns. A task
writes below a hidden folder; only the files of tasks that ended well are moved to their place.
"""

from __future__ import annotations

import operator
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from ampliframe.contracts import integer_argument, require_columns
from ampliframe.functions.arrow_text import flat_bytes
from ampliframe.functions.labels import FASTQ_SUFFIXES
from ampliframe.functions.scale import SLICE_ROWS, join_lookup, running_totals
from ampliframe.sources.ranges import (
    BLOCK_DATA, BLOCK_LIMIT, LAST_BLOCK, READ_BYTES, ByteRange, Piece, RangeGroup, blocks, byte_ranges,
    files_below, first_block, is_blocked, open_filesystem, packed_block, pieces_of, plain_name,
    range_groups, wanted_tasks,
)

#: Fixed value: qualities are stored as characters starting at this code.
PHRED_OFFSET = 33
KINDS = {
    "file": pa.string(),
    "range_start": pa.int64(),
    "row_in_range": pa.int64(),
    "record_offset": pa.int64(),
    "name": pa.string(),
    "seq": pa.string(),
    "qual": pa.string(),
    "length": pa.int64(),
    "mean_quality": pa.float64(),
}
#: Fixed value: the folder of rows whose value is missing or empty.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: columns of a scan that asks for none in particular
COLUMNS = ("file", "range_start", "row_in_range", "record_offset", "name", "seq", "qual")
_SQL = {pa.string(): "string", pa.int64(): "bigint", pa.float64(): "double"}
_COMPARED = {
    EqualTo: operator.eq,
    GreaterThan: operator.gt,
    GreaterThanOrEqual: operator.ge,
    LessThan: operator.lt,
    LessThanOrEqual: operator.le,
}


# ---- records --------------------------------------------------------------------------------


@dataclass
class Lines:
    """Bytes with the start and end of every line, and the lines that are headers.

    `offsets` are the coordinates of the headers. Four lines make a record.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    heads: np.ndarray
    offsets: np.ndarray

    def lengths(self) -> np.ndarray:
        return self.ends[self.heads + 1] - self.starts[self.heads + 1]

    def mean_qualities(self) -> np.ndarray:
        """Phred value of the mean error probability of each read, NaN for an empty one."""
        first, last = self.starts[self.heads + 3], self.ends[self.heads + 3]
        filled = np.flatnonzero(last > first)
        out = np.full(len(self.heads), np.nan)
        if len(filled):
            error = np.power(10.0, -(np.arange(256) - PHRED_OFFSET) / 10.0)
            errors = np.append(error[self.data], 0.0)
            pairs = np.stack([first[filled], last[filled]], 1).ravel()
            sums = np.add.reduceat(errors, pairs)[::2]
            out[filled] = -10 * np.log10(sums / (last - first)[filled])
        return out

    def texts(self, line: int, rows: np.ndarray) -> pa.Array:
        """The given line (0 to 3) of the records `rows`; a header without its mark."""
        if len(self.data) >= 1 << 31:
            raise ValueError("a record is longer than two gigabytes")
        starts = self.starts.copy()
        starts[self.heads] += 1
        # every line is a value, and so is what stands between two lines
        edges = np.stack([starts, self.ends], 1).ravel().astype(np.int32)
        values = pa.StringArray.from_buffers(
            len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(self.data)
        )
        out = values.take(pa.array(2 * (self.heads[rows] + line)))
        if self.data.size and self.data.max() > 127:
            out.validate(full=True)
        return out


def _sync(data: np.ndarray, starts: np.ndarray) -> int | None:
    """The first header line.

    A quality line may start with '@' too, but two lines below it stands a sequence, while two
    lines below a header stands '+'.
    """
    marks = data[starts]
    found = np.flatnonzero((marks[:-2] == ord("@")) & (marks[2:] == ord("+")))
    return int(found[0]) if len(found) else None


def _heads(data, starts, ends, first: int, ended: bool) -> tuple[np.ndarray, int]:
    """Header lines from line `first` on, and the first line that belongs to no whole record.

    Where an ended file stops before the quality of an empty read, the line is taken as there.
    """
    n = len(starts)
    heads = first + 4 * np.arange((n - first) // 4)
    marks = data[starts]
    rest = n - first - 4 * len(heads)
    if (marks[heads] == ord("@")).all() and (marks[heads + 2] == ord("+")).all():
        if not ended or not rest:
            return heads, n - rest
    found, at = [], first
    while at < n:
        if not data[starts[at] : ends[at]].tobytes().strip():
            at += 1
            continue
        if at + 4 > n and not (ended and at + 3 == n and starts[at + 1] == ends[at + 1]):
            break
        if marks[at] != ord("@") or marks[at + 2] != ord("+"):
            break
        found.append(at)
        at += 4
    return np.array(found, np.int64), at


def records(
    pieces: Iterator[Piece], path: str, at_start: bool, end: int | None
) -> Iterator[Lines]:
    """The records that a range owns, from its data and the coordinate of its end."""
    # a buffer begins with the newline before its first line
    held, marks, ended = (b"\n", [(0, -1)], False) if at_start else (b"", [], False)
    synced, beyond = at_start, 0
    while not ended:
        parts, size, more = [held], len(held), 0
        while more < READ_BYTES:
            piece = next(pieces, None)
            if piece is None:
                ended = True
                break
            text, coordinate = piece
            if not size:
                skipped = text.find(b"\n")
                if skipped < 0:
                    continue
                text, coordinate = text[skipped:], coordinate + skipped
            marks.append((size, coordinate))
            parts.append(text)
            size += len(text)
            more += len(text)
            if end is not None and coordinate >= end and more >= beyond:
                # what goes on behind the range is read in growing rounds
                beyond = max(2 * beyond, BLOCK_LIMIT)
                break
        if ended and size and not parts[-1].endswith(b"\n"):
            parts.append(b"\n")
        # one more byte, so that a line may start where the data ends
        buffer = b"".join([*parts, b"\n"])
        data = np.frombuffer(buffer, np.uint8)
        newlines = np.flatnonzero(data[:-1] == 10)
        starts, ends = newlines[:-1] + 1, newlines[1:].copy()
        places, coordinates = (np.array(x, np.int64) for x in zip(*marks)) if marks else ([], [])

        def where(at, places=places, coordinates=coordinates):
            k = np.searchsorted(places, at, "right") - 1
            return coordinates[k] + (at - places[k])

        first = 0
        if not synced:
            first = _sync(data, starts)
            if first is None:
                if not ended:
                    # a header may still be among the last two lines
                    cut = int(newlines[max(len(newlines) - 3, 0)]) if len(newlines) else 0
                    held, marks = _kept(buffer, cut, where, marks)
                continue
            synced = True
        ends -= (ends > starts) & (data[ends - 1] == 13)
        heads, rest = _heads(data, starts, ends, first, ended)
        if ended and len(heads) and heads[-1] + 3 == len(starts):
            starts, ends = np.append(starts, len(data) - 1), np.append(ends, len(data) - 1)
        owned = len(heads)
        if end is not None and owned:
            owned = int(np.searchsorted(where(newlines[heads]), end))
        last = owned < len(heads)
        lines = Lines(data, starts, ends, heads[:owned], where(starts[heads[:owned]]))
        wrong = lines.lengths() != ends[lines.heads + 3] - starts[lines.heads + 3]
        if wrong.any():
            at = lines.offsets[np.flatnonzero(wrong)[0]]
            raise ValueError(f"{path}: sequence and quality differ in length at {at}")
        if owned:
            yield lines
        if last:
            return
        cut_off = rest < len(starts) and (ended or rest + 4 <= len(starts))
        if cut_off and (end is None or where(newlines[rest]) < end):
            raise ValueError(f"{path}: no FASTQ record at {where(starts[rest])}")
        if end is not None and where(newlines[min(rest, len(newlines) - 1)]) >= end:
            return
        held, marks = _kept(buffer, int(newlines[min(rest, len(newlines) - 1)]), where, marks)


def _kept(buffer: bytes, cut: int, where, marks: list[tuple[int, int]]):
    """What is left of a buffer from `cut` on, without the byte added to it, and its marks."""
    left = [(0, int(where(cut)))] if marks else []
    return buffer[cut:-1], left + [(p - cut, c) for p, c in marks if p > cut]


# ---- source ---------------------------------------------------------------------------------


class _FastqReader(DataSourceReader):
    def __init__(self, options):
        self._paths = [p for p in options.get("path", "").split("\n") if p]
        self._split = int(options.get("splitBytes", 64 << 20))
        self._tasks = int(options.get("tasks", 0))
        self._columns = [c for c in options.get("columns", ",".join(COLUMNS)).split(",") if c]
        self._filters: list[Filter] = []

    def partitions(self):
        return range_groups(byte_ranges(files_below(self._paths, FASTQ_SUFFIXES), self._split), self._tasks)

    def read(self, partition: RangeGroup):
        for own in partition.ranges:
            yield from self._read_range(own)

    def _read_range(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        filesystem, inner = open_filesystem(partition.path)
        with filesystem.open_input_file(inner) as raw:
            found = pieces_of(raw, partition)
            if found is None:
                return
            done = 0
            for lines in records(found[0], partition.path, found[1], found[2]):
                yield self._batch(partition, lines, done)
                done += len(lines.heads)

    def _batch(self, partition: ByteRange, lines: Lines, done: int) -> pa.RecordBatch:
        measured = {}
        used = {*self._columns, *(f.attribute[0] for f in self._filters)}
        if "length" in used:
            measured["length"] = lines.lengths()
        if "mean_quality" in used:
            measured["mean_quality"] = lines.mean_qualities()
        keep = np.ones(len(lines.heads), bool)
        for f in self._filters:
            values = measured[f.attribute[0]]
            if isinstance(f, IsNotNull):
                keep &= ~np.isnan(values)
            else:
                # no comparison holds for the missing quality of an empty read
                keep &= _COMPARED[type(f)](values, f.value)
        rows = np.flatnonzero(keep)
        made = {
            "file": lambda: pa.array([partition.path] * len(rows), pa.string()),
            "range_start": lambda: pa.array(np.full(len(rows), partition.start)),
            "row_in_range": lambda: pa.array(done + rows),
            "record_offset": lambda: pa.array(lines.offsets[rows]),
            "name": lambda: lines.texts(0, rows),
            "seq": lambda: lines.texts(1, rows),
            "qual": lambda: lines.texts(3, rows),
            "length": lambda: pa.array(measured["length"][rows]),
            "mean_quality": lambda: pa.array(measured["mean_quality"][rows], from_pandas=True),
        }
        return pa.RecordBatch.from_arrays(
            [made[c]() for c in self._columns],
            schema=pa.schema([(c, KINDS[c]) for c in self._columns]),
        )


class _FilteringReader(_FastqReader):
    """The reader of sessions that push filters; Spark refuses it in any other."""

    def pushFilters(self, filters):
        """Take over comparisons of length and mean quality with a value."""
        for f in filters:
            known = getattr(f, "attribute", None) in (("length",), ("mean_quality",))
            if known and (type(f) in _COMPARED or isinstance(f, IsNotNull)):
                self._filters.append(f)
            else:
                yield f


class FastqDataSource(DataSource):
    """`spark.read.format("fastq")` and its writer; see `scan_fastq` and `write_reads_by`."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        columns = self.options.get("columns", ",".join(COLUMNS)).split(",")
        return ", ".join(f"{c} {_SQL[KINDS[c]]}" for c in columns)

    def reader(self, schema):
        pushed = self.options.get("pushFilters", "false") == "true"
        return (_FilteringReader if pushed else _FastqReader)(self.options)

    def writer(self, schema, overwrite):
        return _FastqWriter(self.options, overwrite)


class _BlockReader(_FastqReader):
    """The blocks of blocked gzip files, from their headers and sizes alone."""

    def _read_range(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path.endswith(".gz"):
            return
        filesystem, inner = open_filesystem(partition.path)
        with filesystem.open_input_file(inner) as raw:
            at = first_block(raw, partition.start, partition.size) if is_blocked(raw) else None
            if at is None:
                return
            rows = []
            for offset, member in blocks(raw, at, partition.end):
                if offset >= partition.end:
                    break
                rows.append((offset, len(member), int.from_bytes(member[-4:], "little")))
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([partition.path] * len(rows), pa.string()),
                    pa.array([partition.start] * len(rows), pa.int64()),
                    *[pa.array(c, pa.int64()) for c in columns],
                ],
                names=["file", "range_start", "block_offset", "block_bytes", "data_bytes"],
            )


class BlockDataSource(DataSource):
    """`spark.read.format("gzip_blocks")`; see `block_index`."""

    @classmethod
    def name(cls):
        return "gzip_blocks"

    def schema(self):
        return (
            "file string, range_start bigint, block_offset bigint, block_bytes bigint, "
            "data_bytes bigint"
        )

    def reader(self, schema):
        return _BlockReader(self.options)


def _loaded(spark: SparkSession, source: type[DataSource], paths, split_bytes: int, **options):
    split_bytes = integer_argument(split_bytes, "split_bytes", 1)
    spark.dataSource.register(source)
    joined = paths if isinstance(paths, str) else "\n".join(paths)
    reader = spark.read.format(source.name()).option("splitBytes", split_bytes)
    reader = reader.option("tasks", wanted_tasks(spark))
    return reader.options(**options).load(joined)


def scan_fastq(
    spark: SparkSession,
    paths: str | Sequence[str],
    split_bytes: int = 64 << 20,
    columns: Sequence[str] = COLUMNS,
) -> DataFrame:
    """Records of FASTQ files or folders: file, range_start, row_in_range, record_offset, name,
    seq, qual.

    `columns` chooses from these and `length` and `mean_quality` (Phred value of the mean error
    probability, NULL for an empty read). Comparisons of the last two with a value are pushed into
    the scan where `spark.sql.python.filterPushdown.enabled` is set when this is called, and then no
    text of a refused read is made; elsewhere Spark filters the rows, with the same result. `record_offset` orders a file: the byte position of the record, of its data in a
    gzip file, or the virtual offset (2^16 times the block's offset plus the place in it) in a
    blocked one. The range columns tell which part of the file a record came from; `row_in_range`
    counts refused reads too.
    """
    unknown = [c for c in columns if c not in KINDS]
    if unknown or not columns:
        raise ValueError(f"a FASTQ scan has no column(s) {', '.join(unknown) or '(none given)'}")
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    options = {"columns": ",".join(columns), "pushFilters": pushed}
    return _loaded(spark, FastqDataSource, paths, split_bytes, **options)


def read_fastq(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int = 64 << 20
) -> DataFrame:
    """Records with a dense 1-based `record_no` per file: file, record_no, name, seq, qual.

    Records before a range are counted by newlines alone; no text is made for that.
    """
    ordered = ("file", "range_start", "row_in_range")
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = scan_fastq(spark, paths, split_bytes, ordered).groupBy("file", "range_start")
    ranges = ranges.agg(F.count(F.lit(1)).alias("n")).select(
        "file", "range_start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
    )
    found = scan_fastq(spark, paths, split_bytes, (*ordered, "name", "seq", "qual"))
    numbered = join_lookup(found, ranges, ["file", "range_start"], "left", SLICE_ROWS)
    number = F.coalesce("__before", F.raise_error(F.lit("the input changed while it was read")))
    return numbered.select(
        "file",
        (number.cast("bigint") + F.col("row_in_range") + 1).alias("record_no"),
        "name",
        "seq",
        "qual",
    )


def block_index(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int = 64 << 20
) -> DataFrame:
    """Blocks of blocked gzip files: file, block_offset, block_bytes, data_offset, data_bytes.

    Each task finds the blocks of its own byte range; where data of a block begins is summed up
    over the ranges. Other files have no rows.
    """
    found = _loaded(spark, BlockDataSource, paths, split_bytes)
    placed = running_totals(
        found,
        group=["file"],
        chunk=[F.col("range_start")],
        order=F.col("block_offset"),
        totals={"data_offset": F.col("data_bytes")},
    )
    return placed.select("file", "block_offset", "block_bytes", "data_offset", "data_bytes")


def with_data_offset(df: DataFrame, index: DataFrame) -> DataFrame:
    """Records of blocked gzip files with `data_offset`, the place of their text in the data."""
    block = index.select(
        "file",
        F.col("block_offset").alias("__block"),
        F.col("data_offset").alias("__data"),
    )
    keyed = df.withColumn("__block", F.shiftright("record_offset", 16))
    joined = keyed.join(block, ["file", "__block"], "left")
    place = F.col("__data") + F.col("record_offset").bitwiseAND(0xFFFF)
    return joined.select(*df.columns, place.alias("data_offset"))


# ---- sink -----------------------------------------------------------------------------------


def fastq_record(name: str = "name", seq: str = "seq", qual: str = "qual"):
    """Four-line text of one read."""
    return F.concat(
        F.lit("@"), F.col(name), F.lit("\n"), F.col(seq), F.lit("\n+\n"), F.col(qual)
    )


def folder_value(value: str | None) -> str:
    """A value as part of a folder's name; the name of no value, as a value, has its first mark escaped."""
    name = quote(value, safe=" -_.,;@!+$&()~") if value else NO_VALUE
    return f"%5F{name[1:]}" if value == NO_VALUE else name


class _Files(WriterCommitMessage):
    def __init__(self, moves: list[tuple[str, str]]):
        self.moves = moves


class _FastqWriter(DataSourceArrowWriter):
    """Rows (by columns, name, seq, qual) that come folder by folder, as FASTQ files."""

    def __init__(self, options, overwrite: bool):
        self.path = plain_name(options["path"]).rstrip("/")
        self.overwrite = overwrite
        self.by = [c for c in options.get("by", "").split(",") if c]
        self.blocked = options.get("compression", "blocked") == "blocked"
        self.level = int(options.get("level", 5))
        self.file_bytes = int(options.get("fileBytes", 256 << 20))
        self.file_rows = int(options.get("fileRows", 1 << 62))
        self.job = uuid.uuid4().hex

    def _working(self) -> str:
        return f"{self.path}/_writing-{self.job}"

    def _folder(self, values: Sequence[str | None]) -> str:
        return "/".join(f"{c}={folder_value(v)}" for c, v in zip(self.by, values))

    def write(self, iterator):
        filesystem, root = open_filesystem(self.path)
        working = root + self._working()[len(self.path) :]
        suffix = ".fastq.gz" if self.blocked else ".fastq"
        moves, attempt = [], uuid.uuid4().hex
        out, folder, held, size, rows = None, None, b"", 0, 0

        def put(data: bytes):
            nonlocal size
            out.write(data)
            size += len(data)

        def add(data: bytes, last: bool = False):
            nonlocal held
            if not self.blocked:
                return put(data)
            held += data
            upto = len(held) if last else len(held) - len(held) % BLOCK_DATA
            for at in range(0, upto, BLOCK_DATA):
                put(packed_block(held[at : at + BLOCK_DATA], self.level))
            held = held[upto:]

        def close():
            nonlocal out
            if out is not None:
                add(b"", last=True)
                if self.blocked:
                    put(LAST_BLOCK)
                out.close()
            out = None

        for batch in iterator:
            columns = dict(zip(batch.schema.names, batch.columns))
            text = pc.binary_join_element_wise(
                pc.binary_join_element_wise("@", columns["name"], ""),
                columns["seq"], "+", columns["qual"], "", "\n",
            )
            if text.null_count:
                raise ValueError("a read has no name, sequence or quality")
            data, bounds = flat_bytes(text)
            keys = list(zip(*[columns[c].cast(pa.string()).to_pylist() for c in self.by]))
            keys = keys or [()] * batch.num_rows
            for i in range(batch.num_rows):
                if out is None or keys[i] != folder or size >= self.file_bytes or rows >= self.file_rows:
                    close()
                    folder, size, rows = keys[i], 0, 0
                    inside = "/".join(filter(None, [self._folder(folder), f"part-{len(moves):05d}-{attempt}{suffix}"]))
                    place = f"{working}/{attempt}/{inside}"
                    filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = filesystem.open_output_stream(place, compression=None)
                    moves.append((place, f"{root}/{inside}"))
                add(data[bounds[i] : bounds[i + 1]].tobytes())
                rows += 1
        close()
        return _Files(moves)

    def commit(self, messages):
        from pyarrow import fs

        filesystem, root = open_filesystem(self.path)
        if self.overwrite:
            for old in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if old.type == fs.FileType.Directory and not old.base_name.startswith("_writing-"):
                    filesystem.delete_dir(old.path)
                elif old.type == fs.FileType.File:
                    filesystem.delete_file(old.path)
        for message in messages:
            for place, target in message.moves if message else ():
                filesystem.create_dir(target.rsplit("/", 1)[0], recursive=True)
                filesystem.move(place, target)
        self._clean(filesystem, root)

    def abort(self, messages):
        self._clean(*open_filesystem(self.path))

    def _clean(self, filesystem, root: str):
        from pyarrow import fs

        working = root + self._working()[len(self.path) :]
        if filesystem.get_file_info(working).type == fs.FileType.Directory:
            filesystem.delete_dir(working)


def write_reads_by(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("group", "barcode"),
    rows_per_file: int | None = None,
    compression: str = "gzip",
    mode: str = "errorifexists",
    file_bytes: int = 256 << 20,
    level: int = 5,
) -> None:
    """Write reads as FASTQ text below one folder per value of the `by` columns.

    Tasks are cut by bytes while the job runs: a folder with a third of all reads is split over
    many tasks, small ones share a task. A task begins a new file at `file_bytes` (and at
    `rows_per_file` reads, if given). "gzip" makes blocked gzip, which any gzip reader reads and
    `scan_fastq` splits; "none" plain text. Repeated and failed tasks leave nothing behind. Modes
    are errorifexists, overwrite and append. The path must be one that all tasks reach.
    """
    from pyarrow import fs

    by = list(by)
    require_columns(df, [*by, "name", "seq", "qual"], "the read set")
    if compression not in ("gzip", "none"):
        raise ValueError("compression must be 'gzip' or 'none'")
    if mode not in ("errorifexists", "error", "overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    filesystem, inner = open_filesystem(path)
    if mode in ("errorifexists", "error") and filesystem.get_file_info(inner).type != fs.FileType.NotFound:
        raise ValueError(f"path {path} already exists")
    spark = df.sparkSession
    spark.dataSource.register(FastqDataSource)
    rows = df.select(*by, "name", "seq", "qual")
    if by:
        rows = rows.hint("rebalance", *by).sortWithinPartitions(*by)
    options = {
        "by": ",".join(by),
        "compression": "blocked" if compression == "gzip" else "none",
        "level": integer_argument(level, "level"),
        "fileBytes": integer_argument(file_bytes, "file_bytes", 1),
    }
    if rows_per_file is not None:
        options["fileRows"] = integer_argument(rows_per_file, "rows_per_file", 1)
    writer = rows.write.format("fastq").options(**options)
    writer.mode("overwrite" if mode == "overwrite" else "append").save(path)
