"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: White space that separates words: space and U+0009 to U+000D, the set bytes.split() uses.
SPACES = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"
#: columns of the documents table
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

ArrowStep = Callable[..., Sequence[pa.Array]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z, and no other letter, in lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def without(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """All columns but those an operator is about to add (names are not case-sensitive)."""
    taken = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def _slices(batch: pa.RecordBatch, column: int, slice_bytes: int | None):
    """The batch in slices whose values of a column take about `slice_bytes`."""
    if slice_bytes is None or batch.num_rows < 2:
        yield batch
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes, dtype=np.int64), 0
    while first < batch.num_rows:
        upto = (ends[first - 1] if first else 0) + slice_bytes
        last = max(int(np.searchsorted(ends, upto, "right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def add_columns(
    df: DataFrame,
    inputs: Sequence[str | Column],
    fields: StructType,
    start: Callable[[], ArrowStep],
    slice_bytes: int | None = None,
) -> DataFrame:
    """`df` with columns computed by Python, one Arrow batch at a time.

    `start` runs once per task and returns the function from the input arrays of a batch to the
    arrays of `fields`. Columns of `df` named like one of `fields` are replaced. Only one batch,
    whose bytes Spark bounds, is held at a time; where a row makes several times its size, give
    `slice_bytes`, and batches are worked on in slices with so many bytes of the first input.
    """
    kept = without(df, fields.names)
    given = [F.col(f"`{c}`") if isinstance(c, str) else c for c in inputs]
    source = df.select(*kept, *[c.alias(f"__in{i}") for i, c in enumerate(given)])
    n_kept, n_in = len(kept), len(given)
    schema = StructType(
        [StructField(f.name, f.dataType, True) for f in source.schema.fields[:n_kept]]
        + fields.fields
    )
    types = [to_arrow_type(f.dataType) for f in fields.fields]

    def run(batches):
        step = None
        for batch in batches:
            step = step or start()
            for part in _slices(batch, n_kept, slice_bytes):
                columns = part.columns
                made = step(*columns[n_kept : n_kept + n_in])
                made = [a if a.type == t else a.cast(t) for a, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([*columns[:n_kept], *made], names=schema.names)

    return source.mapInArrow(run, schema)


def utf8(texts: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    return [t or b"" for t in texts.cast(kind).to_pylist()]


def strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


class WordCache(dict):
    """word -> value, filled on first use, with at most twice `limit` entries.

    At `limit` entries the cache starts anew but still looks into what it held before, so that
    frequent words survive. Words longer than `longest` are never kept. This bounds a worker's
    memory for texts with endless or very long words and changes no value.
    """

    def __init__(self, make: Callable, limit: int = 200_000, longest: int | None = None):
        super().__init__()
        self._make, self._limit, self._longest, self._before = make, limit, longest, {}

    def __missing__(self, word):
        if self._longest is not None and len(word) > self._longest:
            return self._make(word)
        if len(self) >= self._limit:
            self._before = dict(self)
            self.clear()
        value = self._before.get(word)
        if value is None:
            value = self._make(word)
        self[word] = value
        return value


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers as first bytes, second bytes and so on, which compresses best.

    The narrowest of 1, 2, 4 and 8 bytes that holds them all is taken.
    """
    least, most = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    size = next(n for n in (1, 2, 4, 8) if -(1 << 8 * n - 1) <= least and most < 1 << 8 * n - 1)
    planes = numbers.astype(f"<i{size}").reshape(-1, 1).view(np.uint8).T.tobytes()
    return bytes([size]) + len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack_numbers(data: bytes) -> np.ndarray:
    """The numbers of `pack_numbers`, as 64-bit integers."""
    size, total = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], total, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(f"<i{size}").ravel().astype(np.int64)
