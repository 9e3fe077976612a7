"""Sums of small arrays over a table: each task adds up its rows, then the tasks' arrays are added per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PARTIAL = "key int, sums binary"


def summed(rows: DataFrame, scan: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """``scan`` turns a task's batches into one flat array of doubles per key; the sums over all tasks.

    What comes back has the size of one task's result. A key's arrays are added one after the other.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = scan(batches)
        blobs = [np.ascontiguousarray(v, dtype=np.float64).tobytes() for v in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(blobs, pa.binary())], names=["key", "sums"])

    def add(key: tuple[pa.Scalar], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = (np.frombuffer(b, dtype=np.float64) for part in parts for b in part.column("sums").to_pylist())
        total = sum(blobs).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total], pa.binary())], names=["key", "sums"])

    parts = rows.mapInArrow(partial, PARTIAL)
    return {r.key: np.frombuffer(r.sums) for r in parts.groupBy("key").applyInArrow(add, PARTIAL).collect()}
