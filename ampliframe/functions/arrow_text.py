"""Flat numpy views of Arrow string columns for kernels that look at every character."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: rows and bytes of a batch that a kernel with many objects for each row works on at once
SLICED_ROWS = 2048
SLICED_BYTES = 8 << 20


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values laid end to end, start offset of each value plus the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.string():
        column = column.cast(pa.string())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    if data_buffer is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices_by_bytes(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges holding about `limit` bytes each; a longer value stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def in_slices(kernel: Callable[..., pa.Array], *columns: pa.Array) -> pa.Array:
    """What `kernel` makes of the columns of a batch, a slice of bounded rows and bytes at a time.

    The memory of a task then follows neither `maxRecordsPerBatch` nor the length of the texts; a
    longer text stands alone.
    """
    sizes = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        if pa.types.is_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    done = []
    for first, last in slices_by_bytes(np.concatenate([[0], np.cumsum(sizes)]), SLICED_BYTES):
        for at in range(first, last, SLICED_ROWS):
            rows = min(SLICED_ROWS, last - at)
            done.append(kernel(*(c.slice(at, rows) for c in columns)))
    return pa.concat_arrays(done) if done else kernel(*columns)
