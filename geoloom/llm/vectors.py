"""Vectors of fixed length that every task fills and Spark adds up."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

FAN_IN = 16


def _one_a_task(batches, fill: Callable, length: int):
    total = np.zeros(length, np.int64)
    some = False
    for batch in batches:
        some = True
        fill(batch, total)
    if some:
        part = TaskContext.get().partitionId() % FAN_IN
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sums": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def _add(batches, length: int):
    total = np.zeros(length, np.int64)
    for batch in batches:
        for sums in batch.column(1).to_pylist():
            total += np.frombuffer(zlib.decompress(sums), np.int64)
    yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})


def summed(rows: DataFrame, fill: Callable, length: int) -> np.ndarray:
    """What fill(batch, vector) adds over all batches of rows; at most FAN_IN vectors come to the driver."""
    each = rows.mapInArrow(lambda batches: _one_a_task(batches, fill, length), "part int, sums binary")
    sums = each.repartition(FAN_IN, "part").mapInArrow(lambda batches: _add(batches, length), "sums binary")
    return sum((np.frombuffer(row.sums, np.int64) for row in sums.collect()), np.zeros(length, np.int64))
