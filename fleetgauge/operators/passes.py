"""Stochastic passes: many bagged members of a model fitted in one job, and their spread per row.

Member t sees every row with a Poisson weight from a hash of the row's keys and t, so no sample is
drawn, moved or joined: one scan gives the weighted sums of all members. Sizes on the driver and per
task depend on the numbers of members and features only.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T

from fleetgauge.functions.scalars import MIX_ADD, MIX_KEY, MIX_LAST, MIX_STEP, PRIME
from fleetgauge.operators.models import LABEL
from fleetgauge.operators.splits import zero_filled
from fleetgauge.schema import SEED

PASSES = 50  # fixed value: members whose scores are compared
NEWTON_STEPS = 25
_ROWS = 2048  # rows of a block of sums
#: Shares of rows with at most 0, 1, ... copies of a bootstrap sample.
POISSON = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(13)]).tolist()


def pass_weights(keys: Sequence[np.ndarray], passes: int, seed: int = SEED) -> np.ndarray:
    """Weight of each row (rows) in each pass (columns): `functions.scalars.key_uniform` of the
    keys and the pass, as copies of a bootstrap sample."""
    state = np.full(len(keys[0]), seed % PRIME, np.int64)
    for key in keys:
        state = (state * MIX_STEP + np.mod(key, PRIME) * MIX_KEY + 11) % PRIME
    state = (state[:, None] * MIX_STEP + np.arange(passes)[None] * MIX_KEY + 11) % PRIME
    state = (state * state + MIX_ADD) % PRIME
    state = (state * MIX_LAST + 7) % PRIME
    state = (state * state + state + 1) % PRIME
    return np.searchsorted(POISSON, state / float(PRIME), side="right")


class Members(NamedTuple):
    """`coefficients` (features and the intercept last, on scaled features) of each member (columns)."""

    kind: str
    features: list[str]
    centre: np.ndarray
    scale: np.ndarray
    coefficients: np.ndarray


def _design(batch: pa.RecordBatch, features: Sequence[str], centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in features]).astype(float)
    return np.column_stack([(x - centre) / scale, np.ones(len(x))])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _packed(rows: DataFrame, features: Sequence[str], names: Sequence[str], centre: np.ndarray, scale: np.ndarray) -> RDD:
    """Blocks of rows as (design, keys, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            if batch.num_rows:
                keys = [batch.column(n).to_numpy() for n in names]
                held = _design(batch, features, centre, scale), keys, batch.column("_y").to_numpy()[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(held, 5)], pa.binary())], names=["block"])

    return rows.mapInArrow(run, "block binary").rdd.map(lambda row: pickle.loads(row.block), True)


def fit_members(
    train: DataFrame, features: Sequence[str], keys: Sequence, kind: str = "logistic", label: str = LABEL,
    passes: int = PASSES, seed: int = SEED, ridge: float = 1e-6, steps: int = NEWTON_STEPS,
) -> Members:
    """`passes` members on bootstrap weights of the rows. `keys`: integer columns that name a row.

    `linear` fits least squares from one scan; `logistic` takes Newton steps, one scan each for all
    members, until no coefficient moves by more than 1e-8 or `steps` are done. `ridge` is added per
    unit of weight to all but the intercept. Missing features are 0; rows without a label are left out."""
    if kind not in ("linear", "logistic"):
        raise ValueError("kind must be linear or logistic")
    names = [f"_key{i}" for i in range(len(keys))]
    rows = zero_filled(train, features).where(F.col(label).isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y"),
        *[k.cast("bigint").alias(n) for k, n in zip(keys, names)],
    )
    moments = rows.agg(*[m(f).alias(f"{m.__name__}_{i}") for i, f in enumerate(features) for m in (F.avg, F.stddev_pop)]).first()
    centre = np.array([moments[2 * i] or 0.0 for i in range(len(features))])
    scale = np.array([moments[2 * i + 1] or 1.0 for i in range(len(features))])
    width = len(features) + 1
    coefficients = np.zeros((width, passes))

    def step(current: np.ndarray) -> np.ndarray:
        def run(held: Iterator[tuple]) -> Iterator[np.ndarray]:
            sums = np.zeros((passes, width, width + 1))
            for x, row_keys, y in held:
                weights = pass_weights(row_keys, passes, seed).astype(float)
                if kind == "linear":
                    curvature, pull = weights, weights * y
                else:
                    p = 1.0 / (1.0 + np.exp(-np.clip(x @ current, -35, 35)))
                    curvature, pull = weights * p * (1.0 - p), weights * (y - p)
                sums[:, :, width] += (x.T @ pull).T
                columns = np.ascontiguousarray(x.T)
                for i in range(width):  # all members at once, each pair of features once
                    sums[:, i, i:width] += ((columns[i:] * columns[i]) @ curvature).T
            for i in range(width):
                sums[:, i:width, i] = sums[:, i, i:width]
            yield sums

        empty = np.zeros((passes, width, width + 1))
        return packed.mapPartitions(run).treeReduce(np.add) if packed.getNumPartitions() else empty

    packed = _packed(rows, features, names, centre, scale)
    if kind == "logistic":
        packed = packed.persist(StorageLevel.MEMORY_AND_DISK)  # read, filled and scaled once, not in each step
    n = max(1, rows.count())
    penalty = np.diag([ridge * n] * len(features) + [0.0])
    for _ in range(1 if kind == "linear" else steps):
        sums = step(coefficients)
        moved = np.zeros_like(coefficients)
        for t in range(passes):
            pull = sums[t, :, width] - penalty @ coefficients[:, t]
            moved[:, t] = np.linalg.lstsq(sums[t, :, :width] + penalty, pull, rcond=None)[0]
        largest = np.abs(moved).max(initial=0.0)
        coefficients = coefficients + moved * min(1.0, 10.0 / largest if largest else 1.0)
        if largest < 1e-8:
            break
    packed.unpersist()
    return Members(kind, list(features), centre, scale, coefficients)


def add_passes(df: DataFrame, members: Members) -> DataFrame:
    """`df` with n_passes, risk_mean and risk_std (population deviation) of the members' scores.

    A linear member's score is clipped to 0 to 1. Missing features are 0."""
    features, own = members.features, [f"_x{i}" for i in range(len(members.features))]
    rows = df.select(*df.columns, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(x) for f, x in zip(features, own)])
    added = [T.StructField("n_passes", T.LongType()), T.StructField("risk_mean", T.DoubleType()), T.StructField("risk_std", T.DoubleType())]
    passes, columns = members.coefficients.shape[1], df.columns
    names = [*columns, *(f.name for f in added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            raw = _design(batch, own, members.centre, members.scale) @ members.coefficients
            scores = np.clip(raw, 0.0, 1.0) if members.kind == "linear" else 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35)))
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.full(len(scores), passes, np.int64)), pa.array(scores.mean(1)), pa.array(scores.std(1))],
                names=names,
            )

    return rows.mapInArrow(run, T.StructType([*df.schema.fields, *added]))
