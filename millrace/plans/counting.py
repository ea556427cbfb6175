"""Counts by a fixed number of buckets over data of any size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Buckets that a task sends together; the sums of one such piece are made in one task.
PIECE = 1_024


def bucket_sums(df: DataFrame, buckets: Callable[[pa.RecordBatch], Iterator[np.ndarray]], n: int) -> np.ndarray:
    """How often each of ``n`` buckets comes out of ``buckets`` over all batches of ``df``.

    Each task sums for itself and sends its sums in pieces, so that the shuffle is of a fixed size for each task and the
    driver gets n numbers, whatever the number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for part in buckets(batch):
                total += np.bincount(part, minlength=n)
        some = [k for k in range(0, n, PIECE) if total[k : k + PIECE].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[k : k + PIECE] for k in some], pa.list_(pa.int64()))], names=["at", "counts"])

    def add(pdf):
        import pandas as pd

        return pd.DataFrame({"at": pdf["at"].iloc[:1], "counts": [np.sum(np.stack(pdf["counts"].to_numpy()), axis=0)]})

    kind = "at int, counts array<bigint>"
    got = df.mapInArrow(run, kind).groupBy("at").applyInPandas(add, kind).toArrow()  # n / PIECE rows at most
    out = np.zeros(n, np.int64)
    for at, counts in zip(got.column("at").to_pylist(), got.column("counts").combine_chunks() if got.num_rows else (), strict=True):
        out[at : at + len(counts)] = counts.values.to_numpy()
    return out


def bucket_fold(df: DataFrame, fill: Callable[[np.ndarray, pa.RecordBatch], None], n: int, dtype: str, add: np.ufunc, pieces: int = 64) -> np.ndarray:
    """An array of ``n`` that ``fill`` has changed for each batch of ``df``, put together over all tasks by ``add``.

    As ``bucket_sums``, for large arrays: each task sends what isn't zero in ``pieces`` compressed pieces.
    """
    length = -(-n // pieces)
    kind = "at int, packed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype)
        for batch in batches:
            fill(total, batch)
        for k in range(0, n, length):
            if total[k : k + length].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(total[k : k + length], 1)], pa.binary())], names=["at", "packed"])

    def fold(table: pa.Table) -> pa.Table:
        total = 0
        for x in table.column("packed"):
            total = add(total, np.frombuffer(zlib.decompress(x.as_py()), dtype))
        return pa.table([table.column("at").slice(0, 1), pa.array([zlib.compress(total.astype(dtype), 1)], pa.binary())], names=["at", "packed"])

    got = df.mapInArrow(run, kind).groupBy("at").applyInArrow(fold, kind).toArrow()
    out = np.zeros(n, dtype)
    for at, packed in zip(got.column("at").to_pylist(), got.column("packed").to_pylist(), strict=True):
        part = np.frombuffer(zlib.decompress(packed), dtype)
        out[at : at + len(part)] = part
    return out
