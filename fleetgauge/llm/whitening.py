"""Whitening of embeddings along their principal directions.

Rows are centred exactly and reduced by QR block by block: in every task, then in a tree of tasks, to
one triangular factor whose size is the dimension's square. Its singular values and right singular
vectors (`bidiagonal`) are those of all centred rows, so no covariance is ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bidiagonal import right_vectors
from .common import pinned, table
from .vectors import matrix

# Fixed values of the contract: entries c become floor(SCALE c) + OFFSET; components returned.
SCALE = 1024
OFFSET = 100_000
TOP = 8

#: Entries whose integer a double can't hold exactly count as not finite.
_LARGEST = float(1 << 42)
_BLOCK = 4096  # rows of a QR step
_FANOUT = 32  # factors that one task of the tree reduces
_LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not NULL, no NULL, NaN or infinite entry; zero vectors count."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST))


def integers(column: pa.Array) -> np.ndarray:
    return np.floor(SCALE * matrix(column).astype(float)).astype(np.int64) + OFFSET


class Fit(NamedTuple):
    """What the rows have in common: their number, sums, the directions as columns (scaled to unit
    variance), explained shares, and how far the whitened covariance is from the identity."""

    n: int
    sums: list[int]
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in 64 bits where that is certain to hold, else in Python's integers."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once."""
    return (_exact(x, n, sums) / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact squared lengths of n x - S; None where a long can't hold one."""
    far = _exact(x, n, sums)
    rough = (far.astype(float) ** 2).sum(1)
    if rough.max(initial=0.0) < 4e18 and far.dtype != object:
        return (far * far).sum(1).tolist()
    out: list[int | None] = []
    for row, about in zip(far, rough.tolist()):
        whole = sum(int(v) ** 2 for v in row) if about < 2e19 else _LONG + 1
        out.append(whole if whole <= _LONG else None)
    return out


def _fit_rows(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Usable rows of the most frequent length (of equally frequent ones the shortest)."""
    rows = df.where(usable(F.col(vector)))
    most = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    d = most["d"] if most else 0
    return rows.where(F.size(vector) == d), d


def _sums(rows: DataFrame, vector: str) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension: one row a dimension reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # 256 entries of 2^53 fit in 64 bits
                x = integers(batch.column(0).slice(at, 256))
                n, total = n + len(x), total + x.sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                 pa.array([str(t) for t in total])], names=["dim", "n", "s"])

    parts = rows.select(vector).mapInArrow(run, "dim int, n bigint, s string")
    sums = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = sums.orderBy("dim").collect()
    return (found[0]["n"] if found else 0), [int(r["s"]) for r in found]


def _reduced(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if factor is None else np.vstack([factor, rows]), mode="r")


def triangular_factor(rows: DataFrame, vector: str, n: int, sums: list[int]) -> np.ndarray:
    """R of all centred rows, square. Each level of the tree is a written table of one factor a task;
    tasks hold two factors and a block of rows, the driver the last factor."""
    d = len(sums)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                factor = _reduced(factor, centred(integers(batch.column(0).slice(at, _BLOCK)), n, sums))
        if factor is not None:
            at = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([factor.ravel()])], names=["part", "r"])

    def reduce_factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, factor = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([factor.ravel()])], names=["part", "r"])

        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("part")[i].as_py()
                if part is not None and key != part:
                    yield row()
                    factor = None
                part, factor = key, _reduced(factor, batch.column("r")[i].values.to_numpy().reshape(-1, d))
        if part is not None:
            yield row()

    schema = "part bigint, r array<double>"
    factors = pinned(rows.select(vector).mapInArrow(reduce_rows, schema))
    while factors.count() > 1:
        grouped = factors.withColumn("part", F.floor(F.col("part") / _FANOUT))
        factors = pinned(grouped.repartition("part").sortWithinPartitions("part").mapInArrow(reduce_factors, schema))
    found = factors.first()
    factor = np.array(found["r"]).reshape(-1, d) if found else np.zeros((0, d))
    return np.vstack([factor, np.zeros((d - len(factor), d))])


def _identity_error(rows: DataFrame, vector: str, n: int, sums: list[int], directions: np.ndarray) -> float:
    """Largest entry of the measured covariance of the whitened rows minus the identity. Tasks centre
    their own rows; sums of counts, means and centred products are put together."""
    k = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                w = centred(integers(batch.column(0).slice(at, _BLOCK)), n, sums) @ directions
                mean = w.mean(0)
                w -= mean
                products = w.T @ w + len(w) * np.outer(mean, mean)
                yield pa.RecordBatch.from_arrays([pa.array([np.r_[len(w) * mean, products.ravel()]])], names=["v"])

    parts = rows.select(vector).mapInArrow(run, "v array<double>").select(F.posexplode("v"))
    found = np.array([r[1] for r in parts.groupBy("pos").agg(F.sum("col")).orderBy("pos").collect()])
    mean, products = found[:k] / n, found[k:].reshape(k, k) / n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def fit(df: DataFrame, vector: str = "embedding", top: int = TOP) -> Fit | None:
    """Whitening of the usable rows of `df`; None where no direction has a variance: no usable row,
    one distinct vector, or no entries.

    Vectors that are NULL or hold NULL, NaN, infinite entries or such beyond 2^42 are left out, and so
    are those whose length isn't the most frequent one. Components are fewer than `top` where the rows
    span fewer directions (singular values up to d eps times the largest count as zero)."""
    rows, d = _fit_rows(df, vector)
    if d <= 0:
        return None
    n, sums = _sums(rows, vector)
    factor = triangular_factor(rows, vector, n, sums)
    squares, directions = right_vectors(factor, top)
    if not len(squares):
        return None
    scaled = directions / np.sqrt(squares / n)
    return Fit(n, sums, scaled, np.minimum(1.0, squares / (factor**2).sum()), _identity_error(rows, vector, n, sums, scaled))


def whitened(df: DataFrame, fitted: Fit | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row of `df` and component: the id, component (from 1), n, deviation, whitened,
    explained, identity_error. Repeated rows and ids, and NULL ids, stay rows; other columns are left
    out. Deviation is NULL where a long can't hold it. No fit: no rows."""
    fields = [df.schema[id], *(T.StructField(name, kind) for name, kind in (
        ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
        ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())))]
    schema = T.StructType(fields)
    if fitted is None:
        return df.sparkSession.createDataFrame([], schema)
    rows = df.where(usable(F.col(vector)) & (F.size(vector) == len(fitted.sums))).select(id, vector)
    k = fitted.directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                x = integers(part.column(1))
                values = centred(x, fitted.n, fitted.sums) @ fitted.directions
                far = pa.array(deviations(x, fitted.n, fitted.sums), pa.int64())
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(len(x) * k, fitted.n)), far.take(each), pa.array(values.ravel()),
                     pa.array(np.tile(fitted.explained, len(x))), pa.array(np.full(len(x) * k, fitted.identity_error))],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitened(rows, fit(rows))
