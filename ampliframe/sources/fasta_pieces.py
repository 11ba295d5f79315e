"""FASTA records of any length, read as pieces by byte ranges and put together by sums.

A task looks at its own bytes only. What lies between two headers, or between a header and an end
of the range, is a piece; a record that fills twenty ranges has twenty pieces or more. A piece
tells its bases, its newlines and where they stand. Which record a piece goes on with follows from
the headers counted in the ranges before, so only a table with one row per range is accumulated.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from ampliframe.contracts import integer_argument
from ampliframe.functions.scale import SLICE_ROWS, join_lookup
from ampliframe.sources.ranges import (
    ByteRange, RangeGroup, byte_ranges, files_below, open_filesystem, range_groups, wanted_tasks,
)

SPLIT_BYTES = 32 << 20
_FIELDS = {
    "file": pa.string(),
    "range_start": pa.int64(),
    # counts the pieces of a range; the first two go on with what an earlier range began
    "piece": pa.int64(),
    "heads": pa.int64(),
    "name": pa.string(),
    # where the data of a record begins, and the first byte of a piece
    "data_start": pa.int64(),
    "piece_start": pa.int64(),
    "bases": pa.int64(),
    "last_base": pa.int64(),
    "first_newline": pa.int64(),
    "newlines": pa.int64(),
    "stride": pa.int64(),
    # the same of the newlines before the last base
    "inner_newlines": pa.int64(),
    "inner_stride": pa.int64(),
    "first_return": pa.int64(),
    "text": pa.string(),
}
_SQL = {pa.string(): "string", pa.int64(): "bigint"}


def _optional(values: np.ndarray, there: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=~there)


def _strides(newlines: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Bytes from one newline to the next among newlines[first:last]; 0 if they differ, NULL for fewer than two."""
    steps = np.diff(newlines)
    changes = np.flatnonzero(steps[1:] != steps[:-1])
    # a change at k is one between the steps k and k + 1
    even = np.searchsorted(changes, first) == np.searchsorted(changes, np.maximum(last - 2, first))
    there = last - first >= 2
    at = np.minimum(first, max(len(steps) - 1, 0))
    values = np.where(even, steps[at] if len(steps) else 0, 0)
    return _optional(values, there)


class Pieces:
    """The pieces of the bytes `start` to `end` of a file; `read` gives any of its bytes."""

    def __init__(self, path: str, start: int, end: int, read, with_text: bool):
        lead = 1 if start else 0
        # the byte before tells whether a line begins here, the byte after completes a line's end
        raw = read(start - lead, end + 1)
        data = np.frombuffer(raw, np.uint8)
        base = start - lead
        own_end = end - base
        newlines = np.flatnonzero(data[:own_end] == 10)
        starts = newlines + 1
        if not start:
            starts = np.concatenate([[0], starts])
        starts = starts[starts < own_end]
        newlines = newlines[newlines >= lead]
        heads = starts[data[starts] == ord(">")]
        place = np.searchsorted(newlines, heads)
        data_starts = np.append(newlines, own_end)[place] + 1
        names = [raw[a + 1 : b - 1] for a, b in zip(heads.tolist(), data_starts.tolist())]
        if len(heads) and place[-1] == len(newlines):
            # the last header goes on behind the range
            line, at = raw[heads[-1] + 1 : own_end], end
            while more := read(at, at + 65_536):
                cut = more.find(b"\n")
                line += more if cut < 0 else more[:cut]
                at += len(more) if cut < 0 else cut + 1
                if cut >= 0:
                    break
            names[-1], data_starts[-1] = line, at - base
        # what goes on with an earlier line, then what goes on with an earlier record
        until = int(heads[0]) if len(heads) else own_end
        line_end = int(newlines[0]) + 1 if len(newlines) and newlines[0] < until else until
        begins_line = not start or data[0] == 10
        first_line = lead if begins_line else min(line_end, until)
        begin = np.concatenate([[lead, first_line], data_starts])
        stop = np.concatenate([[first_line, until], np.append(heads[1:], own_end)[: len(heads)]])
        stop = np.minimum(np.maximum(stop, begin), own_end)
        inside = np.minimum(begin, own_end)

        first, last = np.searchsorted(newlines, inside), np.searchsorted(newlines, stop)
        returns = np.flatnonzero(data[:own_end] == 13)
        n_returns = np.searchsorted(returns, stop) - np.searchsorted(returns, inside)
        line_returns = returns[data[np.minimum(returns + 1, len(data) - 1)] == 10] if len(returns) else returns
        ends_line = np.isin(data, (10, 13))
        # the last bases of all runs of bases
        tails = np.flatnonzero(~ends_line[:own_end] & np.append(ends_line, True)[1 : own_end + 1])
        upto = np.searchsorted(tails, stop) - 1
        at = np.where(stop > inside, stop - 1, 0)
        whole = (stop > inside) & ~ends_line[at]
        last_base = np.where(whole, stop - 1, tails[upto] if len(tails) else -1)
        has_base = whole | ((upto >= 0) & (last_base >= inside))
        inner = np.where(has_base, np.searchsorted(newlines, last_base), first)
        crlf = np.searchsorted(line_returns, inside)
        has_return = (crlf < len(line_returns)) & (
            np.append(line_returns, own_end)[np.minimum(crlf, len(line_returns))] < stop
        )
        n = len(begin)
        is_head = np.arange(n) >= 2
        padded = np.append(newlines, 0)
        texts = [None] * n
        if with_text:
            plain = [raw[a:b] for a, b in zip(inside.tolist(), stop.tolist())]
            texts = [t.translate(None, b"\r\n").decode("ascii") for t in plain]
        self.columns = {
            "file": pa.array([path] * n, pa.string()),
            "range_start": pa.array(np.full(n, start)),
            "piece": pa.array(np.arange(n)),
            "heads": pa.array(np.maximum(np.arange(n) - 1, 0)),
            "name": pa.array([None, None, *[x.rstrip(b"\r").decode() for x in names]], pa.string()),
            "data_start": _optional(begin + base, is_head),
            "piece_start": pa.array(inside + base),
            "bases": pa.array(stop - inside - (last - first) - n_returns),
            "last_base": _optional(last_base + base, has_base),
            "first_newline": _optional(padded[np.minimum(first, len(newlines))] + base, last > first),
            "newlines": pa.array(last - first),
            "stride": _strides(newlines, first, last),
            "inner_newlines": pa.array(inner - first),
            "inner_stride": _strides(newlines, first, inner),
            "first_return": _optional(np.append(line_returns, 0)[np.minimum(crlf, len(line_returns))] + base, has_return),
            "text": pa.array(texts, pa.string()),
        }


class _PieceReader(DataSourceReader):
    def __init__(self, options):
        self._paths = [p for p in options.get("path", "").split("\n") if p]
        self._split = int(options.get("splitBytes", SPLIT_BYTES))
        self._tasks = int(options.get("tasks", 0))
        self._columns = [c for c in _FIELDS if c != "text" or options.get("text") == "true"]

    def partitions(self):
        files = files_below(self._paths, ("",))
        kept = (f for f in files if not f[0].rsplit("/", 1)[-1].startswith((".", "_")))
        return range_groups(byte_ranges(kept, self._split), self._tasks)

    def read(self, partition: RangeGroup):
        for own in partition.ranges:
            yield self._read_range(own)

    def _read_range(self, partition: ByteRange) -> pa.RecordBatch:
        if partition.path.endswith(".gz"):
            raise ValueError(f"{partition.path}: byte ranges of a compressed file are not records")
        filesystem, inner = open_filesystem(partition.path)
        with filesystem.open_input_file(inner) as raw:

            def read(first: int, last: int) -> bytes:
                raw.seek(first)
                return raw.read(last - first)

            found = Pieces(
                partition.path, partition.start, partition.end, read, "text" in self._columns
            ).columns
        return pa.RecordBatch.from_arrays(
            [found[c] for c in self._columns], schema=pa.schema([(c, _FIELDS[c]) for c in self._columns])
        )


class PieceDataSource(DataSource):
    """`spark.read.format("fasta_pieces")`: pieces of records by byte range."""

    @classmethod
    def name(cls):
        return "fasta_pieces"

    def schema(self):
        columns = [c for c in _FIELDS if c != "text" or self.options.get("text") == "true"]
        return ", ".join(f"{c} {_SQL[_FIELDS[c]]}" for c in columns)

    def reader(self, schema):
        return _PieceReader(self.options)


def _pieces(spark: SparkSession, paths, split_bytes: int, text: bool) -> DataFrame:
    """Pieces with `record_no`, without those of a header that began in an earlier range."""
    split_bytes = integer_argument(split_bytes, "split_bytes", 1)
    spark.dataSource.register(PieceDataSource)
    joined = paths if isinstance(paths, str) else "\n".join(paths)

    def load(with_text: bool) -> DataFrame:
        reader = spark.read.format("fasta_pieces").option("splitBytes", split_bytes)
        reader = reader.option("tasks", wanted_tasks(spark))
        return reader.option("text", str(with_text).lower()).load(joined)

    return numbered(load(text), load(False))


def numbered(found: DataFrame, counted: DataFrame) -> DataFrame:
    """Pieces with `record_no`, from the headers `counted` in the ranges before theirs."""
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranges = counted.groupBy("file", "range_start").agg(
        F.max("heads").alias("n"), F.max("data_start").alias("reach")
    )
    ranges = ranges.select(
        "file",
        "range_start",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"),
        F.coalesce(F.max("reach").over(before), F.lit(0)).alias("__reach"),
    )
    found = join_lookup(found, ranges, ["file", "range_start"], "left", SLICE_ROWS)
    of_header = (F.col("piece") == 0) & (F.col("__reach") > F.col("range_start"))
    filled = (F.col("bases") + F.col("newlines") > 0) | F.col("first_return").isNotNull()
    kept = found.filter(~of_header & (filled | (F.col("piece") > 1)))
    placed = kept.withColumn("record_no", F.col("__before") + F.col("heads"))
    stray = F.raise_error(F.concat(F.lit("sequence without a header in "), F.col("file")))
    checked = F.when((F.col("record_no") == 0) & (F.col("bases") > 0), stray.cast("bigint"))
    return placed.withColumn("record_no", F.coalesce(checked, "record_no")).filter("record_no > 0")


def index_rows(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Index rows of FASTA files as stored: file, record_no, name, length, offset, line_bases, line_bytes.

    Records may be longer than a split, or than a string can be. Raises while running if a record's
    lines differ in length before its last one, or the last one is longer.
    """
    return index_of(_pieces(spark, paths, split_bytes, False))


def index_of(found: DataFrame) -> DataFrame:
    """Index rows from numbered pieces; see `index_rows`."""
    record = Window.partitionBy("file", "record_no")
    end = F.col("__end")
    placed = found.select(
        "*",
        F.max("last_base").over(record).alias("__end"),
        F.min("first_newline").over(record).alias("__newline"),
        F.min("first_return").over(record).alias("__return"),
        F.max("data_start").over(record).alias("__start"),
    )
    line = F.col("__newline") - F.col("__start") + 1
    # of the piece with the last base only the newlines before it count, of later ones none
    last = F.col("last_base") == end
    ahead = F.col("piece_start") <= end
    counted = F.when(last, F.col("inner_newlines")).when(ahead, F.col("newlines")).otherwise(0)
    stride = F.when(last, F.col("inner_stride")).when(ahead, F.col("stride"))
    off = (counted > 0) & (
        ((F.col("first_newline") + 1 - F.col("__start")) % line != 0)
        | F.coalesce(stride != line, F.lit(False))
    )
    rows = placed.groupBy("file", "record_no").agg(
        F.max("name").alias("title"),
        F.sum("bases").alias("length"),
        F.max("__start").alias("offset"),
        F.max(end).alias("end"),
        F.max("__newline").alias("newline"),
        F.max("__return").alias("line_return"),
        F.sum(counted).alias("lines"),
        F.bool_or(F.coalesce(off, F.lit(False))).alias("off"),
    )
    line = F.col("newline") - F.col("offset") + 1
    folded = F.col("newline") < F.col("end")
    ends = F.when(F.col("line_return") < F.col("end"), 2).otherwise(1)
    width = F.when(F.col("length") == 0, 0).when(folded, line - ends).otherwise(F.col("length"))
    rows = rows.withColumn("line_bases", width.cast("bigint"))
    reach = F.col("end") - F.col("offset")
    uneven = folded & (
        F.col("off")
        | (F.floor(reach / line) != F.col("lines"))
        | (reach % line >= F.col("line_bases"))
    )
    name = F.regexp_extract("title", r"^(\S*)", 1)
    complaint = F.raise_error(F.concat(F.lit("uneven line lengths in record "), name))
    return rows.select(
        "file",
        "record_no",
        name.alias("name"),
        F.when(F.coalesce(uneven, F.lit(False)), complaint.cast("bigint"))
        .otherwise(F.col("length"))
        .alias("length"),
        "offset",
        "line_bases",
        F.when(F.col("line_bases") > 0, F.col("line_bases") + ends)
        .otherwise(0)
        .cast("bigint")
        .alias("line_bytes"),
    )


def scan_fasta_chunks(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Sequences in chunks of at most a split: file, record_no, start, bases.

    `start` counts the bases of the record before the chunk, so the chunks of a record put
    together by `start` are its sequence. Records without bases have one empty chunk. Works for
    records of any length; no task holds more than a split.
    """
    found = _pieces(spark, paths, split_bytes, True).filter("bases > 0 or name is not null")
    ordered = Window.partitionBy("file", "record_no").orderBy("range_start", "piece")
    start = F.coalesce(
        F.sum("bases").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    chunks = found.select(
        "file", "record_no", start.alias("start"), F.col("text").alias("bases"),
        F.sum("bases").over(Window.partitionBy("file", "record_no")).alias("__all"), "bases",
    ).toDF("file", "record_no", "start", "bases", "__all", "__own")
    # a header at the very end of a range has its bases in later chunks
    return chunks.filter("__own > 0 or __all = 0").select("file", "record_no", "start", "bases")
