"""Permutation importance: how much average precision falls when a feature's values are dealt to
other rows.

Rows are numbered in the order of a key hash; repeat r sends row i to row (a i + b) mod n with a step
prime to n. That is a permutation without a sort per repeat, the same on every run, and one join
brings all features of the image at once. The variants of all features and repeats are scored and
measured in one grouped job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import numbered
from fleetgauge.functions.scalars import key_hash
from fleetgauge.operators.metrics import ranking_metrics, score_histogram
from fleetgauge.operators.models import LABEL
from fleetgauge.schema import SEED
from fleetgauge.session import evenly, pinned

REPEATS = 5
# Large primes; those that don't divide the number of rows are steps.
STEPS = [15485863, 32452843, 49979687, 67867967, 86028121, 104395301, 122949823, 141650939]
SHIFT = 7919


def steps(n: int, repeats: int) -> list[tuple[int, int]]:
    """Step and shift of each repeat; steps are prime to `n`."""
    fitting = [p for p in STEPS if n % p]
    if repeats > len(fitting):
        raise ValueError(f"at most {len(fitting)} repeats")
    return [(p, SHIFT * (r + 1)) for r, p in enumerate(fitting[:repeats])]


def add_index(df: DataFrame, keys: Sequence[Column], seed: int = SEED) -> DataFrame:
    """`_index` from 0 by a hash of integer `keys`, then the keys: slices of bounded size, no global
    window. Rows that share all keys stand in any order."""
    names = [f"_order{i}" for i in range(len(keys))]
    marked = df.withColumns({"_hash": key_hash(seed, *keys), **{n: k.cast("bigint") for n, k in zip(names, keys)}})
    out = numbered(marked, [], ["_hash", *names], "_index", hot=True)
    return out.withColumn("_index", F.col("_index") - 1).drop("_hash", *names)


def permuted(indexed: DataFrame, n: int, repeats: int, values: Sequence[str]) -> DataFrame:
    """`indexed` once per repeat (`repeat` from 0) with `_image` and `from_{c}`: the values of the row
    at the image's place."""
    table = F.array(*[F.struct(F.lit(a).alias("step"), F.lit(b).alias("shift")) for a, b in steps(n, repeats)])
    rows = indexed.select("*", F.posexplode(table).alias("repeat", "_step"))
    image = (F.col("_index") * F.col("_step.step") + F.col("_step.shift")) % F.lit(n)
    rows = rows.withColumn("_image", image).drop("_step")
    theirs = indexed.select(F.col("_index").alias("_image"), *[F.col(c).alias(f"from_{c}") for c in values])
    return rows.join(theirs, "_image")


def permutation_importance(
    df: DataFrame, features: Sequence[str], keys: Sequence[Column], score: Callable[[DataFrame], DataFrame],
    label: str = LABEL, repeats: int = REPEATS, seed: int = SEED,
) -> DataFrame:
    """`(feature, importance, deviation)`: mean and population deviation over the repeats of the fall
    in average precision. `score` adds `risk` from an array column `_x` in the order of `features`;
    missing features are 0. An empty frame gives no rows."""
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    rows = df.where(F.col(label).isNotNull()).select(values.alias("_x"), F.col(label).alias("_y"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    base = add_index(rows, [F.col(f"_k{i}") for i in range(len(keys))], seed).select("_index", "_x", "_y")
    base = pinned(evenly(base, rows.count()))  # each row is scored many times, in the task that reads it here
    n = base.count()
    names = F.array(*[F.lit(f) for f in features])
    whole = base.select(F.lit("").alias("feature"), F.lit(0).alias("repeat"), "_x", "_y")
    if n:
        drawn = permuted(base, n, repeats, ["_x"])
        dealt = drawn.select("repeat", "_y", "_x", "from__x", F.posexplode(names).alias("_at", "feature"))
        mixed = F.transform("_x", lambda v, i: F.when(i == F.col("_at"), F.get("from__x", F.col("_at"))).otherwise(v))
        whole = whole.unionByName(dealt.select("feature", "repeat", mixed.alias("_x"), "_y"))
    groups = ["feature", "repeat"]
    found = pinned(ranking_metrics(score_histogram(score(whole), groups, "_y"), groups))
    whole_score = found.where("feature = ''").agg(F.max("pr_auc").alias("v"))
    falls = found.where("feature <> ''").withColumn("_fall", whole_score.scalar() - F.col("pr_auc"))
    return falls.groupBy("feature").agg(F.avg("_fall").alias("importance"), F.stddev_pop("_fall").alias("deviation"))


def risk_of(model: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    """Scores `_x` with the last stage of a fitted classifier."""

    def score(df: DataFrame) -> DataFrame:
        out = model.stages[-1].transform(df.withColumn("_features", array_to_vector("_x")))
        return out.withColumn("risk", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")

    return score
