"""Arrow string columns as flat arrays of code points, and back."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Batches are worked on in slices of about so many bytes of text, so that memory doesn't follow the longest batch.
SLICE_BYTES = 4 << 20


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; nulls are empty."""
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    _, at, data = col.buffers()
    offsets = np.frombuffer(at, np.int64, n + 1, col.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def to_code_points(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, starts): row k is code_points[starts[k]:starts[k + 1]]."""
    raw, offsets = text_bytes(col)
    try:
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # bytes that are no UTF-8: row by row, each bad byte as U+FFFD
        rows = [np.frombuffer(raw[a:b].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        return np.concatenate([np.zeros(0, np.uint32), *rows]), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
    first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return points, first[offsets].astype(np.int64)


def from_code_points(points: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The string column of these code points."""
    data = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "replace")
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    width[(points >= 0xD800) & (points < 0xE000)] = 1  # a lone surrogate is written as ?
    at = np.concatenate([[0], np.cumsum(width)])[starts]
    return pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most`` bytes of its text column, of one row at least."""
    _, offsets = text_bytes(batch.column(column))
    k = 0
    while k < batch.num_rows:
        end = max(k + 1, int(np.searchsorted(offsets, offsets[k] + most, side="right")) - 1)
        yield batch.slice(k, end - k)
        k = end
