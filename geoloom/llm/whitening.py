"""Embedding whitening by an exact integer covariance from digit-slice matrix products.

Entries become whole numbers x. n rows with sums S make whole numbers y = n * x - S, which are centred exactly. Each is
split into limbs of LIMB bits, so that a float64 product of two limb matrices over few enough rows holds whole
numbers below 2^53 and loses nothing. Tasks put the limbs' products together as big integers; these are added up,
and only the eigendecomposition of their sum is done in floating point.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm.textvec import tidy
from geoloom.llm.vectors import FAN_IN
from geoloom.storage import cut_lineage

#: An entry is counted in steps of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: Bits of a limb, and rows in a product: 2 ** (2 * LIMB) * ROWS is 2^53 at most.
LIMB = 20
ROWS = 1 << 13
#: Longest vector: a task holds a few square matrices of this side.
MAX_SIZE = 2048
#: Numbers of a batch's matrix in a task at a time.
CELLS = 1 << 20


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """values, integers or big integers, as float64 limbs of LIMB bits from the lowest on; the last one has the sign.

    All but the last lie in 0 .. 2^LIMB - 1, and the last in -2^LIMB .. 2^LIMB - 1.
    """
    found = []
    while True:
        if not len(values) or (values.min() >= -(1 << LIMB) and values.max() < 1 << LIMB):
            return [*found, values.astype(np.float64)]
        found.append((values & ((1 << LIMB) - 1)).astype(np.float64))
        values = values >> LIMB


def gram(values: np.ndarray) -> np.ndarray:
    """values.T @ values of an integer matrix, exactly, as big integers."""
    size = values.shape[1]
    by_weight: dict[int, np.ndarray] = {}
    for at in range(0, len(values), ROWS):
        parts = limbs(values[at : at + ROWS])
        for j, left in enumerate(parts):
            for k, right in enumerate(parts[j:], j):
                product = (left.T @ right).astype(np.int64).astype(object)
                by_weight[j + k] = by_weight.get(j + k, 0) + (product if j == k else product + product.T)
    total = np.zeros((size, size), object)
    for weight, part in by_weight.items():
        total += part << (LIMB * weight)
    return total


def whole(matrix: list | np.ndarray, size: int) -> np.ndarray:
    """Lists of integers as a matrix of so many columns, of int64 where all fit with room to spare and else of big ones."""
    return np.asarray(matrix, np.int64).reshape(-1, size)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums in whole numbers: int64 where that can't overflow, else big integers."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _matrices(batches, size: int, at: int = 0):
    """The vectors of a column as integer matrices of a bounded number of cells, with their batch and first row."""
    for batch in batches:
        column = batch.column(at)
        step = max(1, CELLS // max(size, 1))
        for first in range(0, len(column), step):
            some = column.slice(first, step)
            yield batch, first, whole(some.flatten().to_numpy(zero_copy_only=False), size)


def _pack(numbers) -> pa.RecordBatch:
    part = TaskContext.get().partitionId() % FAN_IN
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sums": pa.array([json.dumps([int(v) for v in numbers])], pa.string())})


def _each(batches, size: int, add):
    total = None
    for _, _, x in _matrices(batches, size):
        found = add(x)
        total = found if total is None else total + found
    if total is not None:
        yield _pack(total)


def _add(batches):
    total = None
    for batch in batches:
        for row in batch.column(1).to_pylist():
            found = np.array(json.loads(row), object)
            total = found if total is None else total + found
    if total is not None:
        yield _pack(total)


def added(rows: DataFrame, size: int, length: int, add) -> list[int]:
    """What add(matrix) gives, big integers, over all vectors of rows; a list of each task, then FAN_IN lists, then one."""
    kind = "part int, sums string"
    each = rows.mapInArrow(lambda batches: _each(batches, size, add), kind)
    sums = each.repartition(FAN_IN, "part").mapInArrow(_add, kind).repartition(1).mapInArrow(_add, kind).collect()
    return json.loads(sums[0].sums) if sums else [0] * length


def usable(vector: Column) -> Column:
    """Whether a vector is there and each of its entries is a finite number."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def steps(vector: Column, size: int) -> Column:
    """Entries in whole steps of 1 / SCALE, rounded down; what a vector lacks to size counts as 0."""
    missing = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(size) - F.size(vector), F.lit(0)))
    return F.concat(F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long")), missing)


@dataclass
class Whitening:
    """n distinct vectors with sums, and for each component its eigenvector, eigenvalue and share of the trace."""

    size: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, y: np.ndarray) -> np.ndarray:
        """The whitened values of centred rows, one column for each component; 0 along one without spread."""
        out = (y.astype(np.float64) / max(self.n, 1)) @ self.vectors
        return np.where(self.values > 0, out / np.sqrt(np.where(self.values > 0, self.values, 1.0)), 0.0)


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of vectors (x array<long>), each of which counts once; it reads them twice.

    The driver gets one matrix of big integers. Eigenvalues that are only rounding count as 0.
    """
    totals = added(vectors, size, size + 1, lambda x: np.array([*(x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0), len(x)], object))
    n, sums = totals[-1], totals[:-1]
    upper = np.triu_indices(size)
    flat = added(vectors, size, len(upper[0]), lambda x: gram(centred(x, n, sums))[upper]) if n else [0] * len(upper[0])
    covariance = np.zeros((size, size))
    covariance[upper] = [v / n**3 if n else 0.0 for v in flat]  # big integers divide to the nearest double
    covariance += np.triu(covariance, 1).T
    diagonal = np.flatnonzero(upper[0] == upper[1]).tolist()
    values, found = np.linalg.eigh(covariance)
    values, found = values[::-1][:components], found[:, ::-1][:, :components]
    # The same sign in each run: the entry of the largest size is positive.
    found = found * np.array([1.0 if v[np.argmax(np.abs(v))] >= 0 else -1.0 for v in found.T])
    trace = sum(flat[k] for k in diagonal) / n**3 if n else 0.0
    values = np.where(values > trace * size * 1e-15, values, 0.0)
    return Whitening(size, n, sums, found, values, values / trace if trace > 0 else np.zeros(len(values)))


@tidy
def _project(batches, model: Whitening):
    """x -> one column for each component."""
    for _, _, x in _matrices(batches, model.size):
        out = model.project(centred(x, model.n, model.sums))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out.T], [f"w{k}" for k in range(out.shape[1])])


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, by a pass over them."""
    k = len(model.values)
    if not model.n or not k:
        return 0.0
    rows = vectors.mapInArrow(partial(_project, model=model), ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).collect()[0]
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


@tidy
def _whiten(batches, model: Whitening, error: float):
    k = len(model.values)
    numbers = pa.array(np.arange(1, k + 1), pa.int32())
    for batch, first, x in _matrices(batches, model.size, 1):
        y = centred(x, model.n, model.sums)
        rows = len(y)
        if y.dtype != object and y.size and max(abs(int(y.min())), abs(int(y.max()))) ** 2 * model.size >= 1 << 63:
            y = y.astype(object)
        deviation = [v if v < 10**38 else None for v in (int(v) for v in (y * y).sum(axis=1))]
        repeated = np.repeat(np.arange(rows), k)
        ids = batch.column(0).slice(first, rows).take(pa.array(repeated))
        exact = pa.array([None if v is None else Decimal(v) for v in deviation], pa.decimal128(38, 0)).take(pa.array(repeated))
        numbered = numbers.take(pa.array(np.tile(np.arange(k), rows)))
        share = pa.array(np.tile(model.explained, rows))
        yield pa.RecordBatch.from_arrays([ids, numbered, pa.array(np.full(rows * k, model.n)), exact, pa.array(model.project(y).ravel()), share, pa.array(np.full(rows * k, error))], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    A row is usable if its vector is there and holds finite numbers alone. The fit takes each distinct vector of steps
    once, however often it comes. deviation is a decimal(38, 0), null if larger. A vector shorter than the longest one
    counts as if zeros followed; vectors longer than MAX_SIZE raise ValueError. There are as many components as
    entries at most. One without spread (too few distinct vectors) has whitened 0 and explained 0, and shows in
    identity_error. Entries too large for a long of steps count as its end. Null ids and repeated rows are rows like
    others; other columns are not read; a table without a usable row gives an empty result.
    """
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(usable(F.col("vector")))
    size = max(kept.agg(F.max(F.size("vector"))).collect()[0][0] or 0, 1)
    if size > MAX_SIZE:
        raise ValueError(f"vectors of {size} entries; {MAX_SIZE} is the most")
    kind = kept.schema["id"].dataType.simpleString()
    kept = kept.select("id", steps(F.col("vector"), size).alias("x"))
    distinct = cut_lineage(kept.select("x").distinct())  # read three times below
    model = fit(distinct, size, components)
    error = identity_error(distinct, model)
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return kept.mapInArrow(partial(_whiten, model=model, error=error), schema).withColumnRenamed("id", id_col)


def whitened_digest(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """whiten() with deviation as a long, null beyond its range."""
    return whiten(rows, id_col, vector_col).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
