"""Sums of numpy vectors over all partitions, by key.

For statistics that are matrices: a partition's rows are turned into a few
vectors, and these are added up in a shuffle by key, so that neither a task nor
the driver holds the vectors of all partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 20_000       # rows of a matrix
SCHEMA = pa.schema([("k", pa.int32()), ("v", pa.binary())])


def matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns as a matrix of doubles; nulls are NaN."""
    out = np.empty((batch.num_rows, len(names)))
    for i, n in enumerate(names):
        out[:, i] = batch.column(n).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return out


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, ROWS):
            yield b.slice(a, ROWS)


def _rows(got: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array([v.tobytes() for v in got.values()], pa.binary())],
                                      schema=SCHEMA)


def added(df: DataFrame, scan: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """The vectors (of doubles) that ``scan`` gives for every partition, added up by
    key.  The driver gets one vector a key."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _rows(scan(blocks(batches)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column("k").to_pylist(), b.column("v").to_pylist(), strict=True):
                new = np.frombuffer(v)
                total[k] = total[k] + new if k in total else new
        yield _rows(total)

    got = df.mapInArrow(one, "k int, v binary").repartition("k").mapInArrow(add, "k int, v binary").collect()
    return {r["k"]: np.frombuffer(bytes(r["v"])) for r in got}


def centre(df: DataFrame, names: Sequence[str], rows: int = 1000) -> np.ndarray:
    """Means of some rows: sums taken about them keep the digits of large values
    with a small spread.  Any point will do; 0 where there is no value."""
    some = df.select(*names).limit(rows).toArrow()
    if not some.num_rows:
        return np.zeros(len(names))
    x = np.concatenate([matrix(b, names) for b in some.to_batches()])
    ok = np.isfinite(x)
    return np.where(ok, x, 0.0).sum(axis=0) / np.maximum(ok.sum(axis=0), 1)
