"""Quantile regression from leaves: a row's quantiles are those of the training rows that share its
leaves, each tree counting the rows of its leaf together as one (Meinshausen, 2006).

Per tree and leaf the targets are kept as counts on a grid, one map-side aggregate, so training rows
are never paired with scored ones. The tables hold trees x leaves x grid numbers, bounded by the
forest's parameters whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F, types as T

from fleetgauge.functions.ordering import quantiles
from fleetgauge.operators.splits import zero_filled
from fleetgauge.schema import QUANTILE_HIGH, QUANTILE_LOW, SEED
from fleetgauge.session import pinned

TREES = 50
DEPTH = 8
LEAST_ROWS = 10
GRID = 256
#: Numbers that the tables may hold: 2^26 doubles are half a gigabyte.
_MOST = 1 << 26


class LeafTables(NamedTuple):
    """`grid`: rising target values; per tree the known leaf ids, rising, and for each the share of
    its training rows up to each grid value."""

    grid: np.ndarray
    leaves: list[np.ndarray]
    shares: list[np.ndarray]


def target_grid(train: DataFrame, target: str, size: int = GRID) -> list[float]:
    """Every value of the target if there are at most `size`, else that many of its quantiles
    (each an interpolated value, the largest included)."""
    distinct = train.select(F.col(target).cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)").distinct()
    few = [r["v"] for r in distinct.limit(size + 1).collect()]
    if len(few) <= size:
        return sorted(few)
    levels = {f"q{i}": (i + 1) / size for i in range(size)}
    row = quantiles(train, [], target, levels).first()
    return sorted({row[q] for q in levels})


def leaf_tables(train: DataFrame, leaves: str, target: str, grid: Sequence[float]) -> LeafTables:
    """Counts of `train` (array column `leaves`: one leaf id per tree) on the grid. A target counts at
    the first grid value that isn't below it; rows without target or leaves are left out."""
    at = np.array(grid, float)
    value = F.col(target).cast("double")
    edges = F.array(*[F.lit(float(g)) for g in grid]) if len(grid) else F.array().cast("array<double>")
    place = F.least(F.size(F.filter(edges, lambda g: g < value)), F.lit(max(len(at) - 1, 0)))
    placed = train.where(value.isNotNull() & ~F.isnan(value)).select(place.alias("place"), F.col(leaves).alias("leaves"))
    rows = placed.select("place", F.posexplode("leaves").alias("tree", "leaf"))  # places are found before rows multiply
    counts = pinned(rows.groupBy("tree", F.col("leaf").cast("bigint").alias("leaf"), "place").agg(F.count(F.lit(1)).alias("n")))
    sizes = counts.groupBy("tree").agg(F.countDistinct("leaf").alias("leaves")).collect()  # one row a tree
    if sum(r["leaves"] for r in sizes) * max(len(at), 1) > _MOST:
        raise ValueError("trees x leaves x grid exceeds the bound; use shallower trees or a coarser grid")
    found = np.array([tuple(r) for r in counts.collect()], np.int64).reshape(-1, 4)
    ids, shares = [], []
    for tree in range(int(found[:, 0].max(initial=-1)) + 1):
        _, leaf, place, n = found[found[:, 0] == tree].T
        ids.append(np.unique(leaf))
        table = np.zeros((len(ids[-1]), len(at)))
        table[np.searchsorted(ids[-1], leaf), place] = n
        table = np.cumsum(table, axis=1)
        shares.append(table / table[:, -1:])
    return LeafTables(at, ids, shares)


def add_leaf_quantiles(df: DataFrame, tables: LeafTables, leaves: str, levels: dict[str, float]) -> DataFrame:
    """`df` with a column per level: the smallest grid value whose share over the row's leaves reaches
    it. Trees whose leaf held no training row don't count; NULL if none counts."""
    rest = [c for c in df.columns if c not in levels]
    rows = df.select(*rest)
    at = rest.index(leaves)
    wanted = np.array(list(levels.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                column = batch.column(at)
                total, trees = np.zeros((batch.num_rows, len(tables.grid))), np.zeros(batch.num_rows)
                some = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                given = column.drop_null().flatten().to_numpy(zero_copy_only=False)
                ids = given.reshape(len(some), -1).astype(np.int64) if len(some) else np.zeros((0, 0), np.int64)
                for tree in range(min(ids.shape[1], len(tables.leaves))):
                    known = tables.leaves[tree]
                    place = np.minimum(np.searchsorted(known, ids[:, tree]), max(len(known) - 1, 0))
                    ok = known[place] == ids[:, tree] if len(known) else np.zeros(len(some), bool)
                    total[some[ok]] += tables.shares[tree][place[ok]]
                    trees[some[ok]] += 1
                out = []
                for level in wanted:
                    reach = total >= level * trees[:, None] - 1e-9 * np.maximum(trees[:, None], 1)
                    first = reach.argmax(1) if len(tables.grid) else np.zeros(len(trees), np.int64)
                    values = tables.grid[first] if len(tables.grid) else np.zeros(len(trees))
                    out.append(pa.array(values, mask=trees == 0))
                yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*rest, *levels])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in levels]]))


class QuantileForest(NamedTuple):
    model: PipelineModel
    features: list[str]
    tables: LeafTables


def _with_leaves(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    assembled = VectorAssembler(inputCols=list(features), outputCol="_features").transform(zero_filled(df, features))
    out = model.transform(assembled)
    return out.withColumn("_leaves", vector_to_array("_leaf").cast("array<bigint>")).drop("_features", "_leaf", "_rul")


def train_quantile_forest(
    train: DataFrame, features: Sequence[str], target: str = "rul", trees: int = TREES, depth: int = DEPTH,
    least: int = LEAST_ROWS, grid: int = GRID, seed: int = SEED,
) -> QuantileForest:
    """A regression forest and the targets of its leaves."""
    forest = RandomForestRegressor(
        featuresCol="_features", labelCol=target, predictionCol="_rul", leafCol="_leaf", numTrees=trees, maxDepth=depth,
        minInstancesPerNode=least, featureSubsetStrategy="onethird", seed=seed,
    )
    vectors = VectorAssembler(inputCols=list(features), outputCol="_features").transform(zero_filled(train, features))
    model = Pipeline(stages=[forest]).fit(vectors.select("_features", target))
    leaves = _with_leaves(model, train.select(*{*features, target}), features)
    return QuantileForest(model, list(features), leaf_tables(leaves, "_leaves", target, target_grid(train, target, grid)))


def add_quantile_interval(
    df: DataFrame, forest: QuantileForest, low: float = QUANTILE_LOW, high: float = QUANTILE_HIGH
) -> DataFrame:
    """`rul_lower`, `rul_median`, `rul_upper` of every row; lower never exceeds upper."""
    levels = {"rul_lower": low, "rul_median": 0.5, "rul_upper": high}
    return add_leaf_quantiles(_with_leaves(forest.model, df, forest.features), forest.tables, "_leaves", levels).drop("_leaves")
