"""Survival rows, proportional hazards by distributed Newton steps, and concordance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import numbered, oversized, quantiles, running
from fleetgauge.functions.scalars import key_hash, key_uniform, text_key
from fleetgauge.operators.labels import per_unit
from fleetgauge.operators.splits import _placed
from fleetgauge.operators.stats import varying_features
from fleetgauge.schema import CENSORING_RATIO, CYCLE, KEYS, SEED
from fleetgauge.session import pinned

# Penalty, variance floor, kept features, bootstrap size and its minimum.
PENALIZER = 0.1
MIN_VARIANCE = 1e-8
MAX_FEATURES = 50
BOOTSTRAPS = 200
MIN_VALID = 10


def survival_rows(
    df: DataFrame, features: Sequence[str], ratio: float = CENSORING_RATIO, seed: int = SEED,
    hot: bool | None = None,
) -> DataFrame:
    """One row per unit: features at the last kept reading, `duration`, `event`.

    With probability `ratio`, a unit of more than 3 readings is cut after a random one of its
    first n - 1 readings and counts as censored. Draws depend on the unit only.
    """
    if hot is None:
        hot = oversized(df, KEYS)
    placed = numbered(df.select(*KEYS, CYCLE, *features), KEYS, [CYCLE], "_at", hot=hot)
    sized = per_unit(placed, hot, _n=F.count(F.lit(1)))
    unit = [text_key(F.col("variant")), F.col("unit_id")]
    censored = (key_uniform(seed, *unit, F.lit(1)) < ratio) & (F.col("_n") > 3)
    cut = F.lit(1) + F.floor(key_uniform(seed, *unit, F.lit(2)) * (F.col("_n") - 1))
    kept = sized.withColumns(
        {"_last": F.when(censored, cut).otherwise(F.col("_n")), "_event": F.when(censored, 0).otherwise(1)}
    ).where("_at <= _last")
    rows = kept.groupBy(*KEYS).agg(
        *[F.max_by(c, CYCLE).alias(c) for c in features],
        F.max(CYCLE).alias("duration"),
        F.max("_event").alias("event"),
    )
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    return rows.select(*KEYS, *filled, "duration", "event")


@dataclass(frozen=True)
class CoxModel:
    features: list[str]
    mean: list[float]
    std: list[float]
    beta: list[float]  # on standardised features
    log_likelihood: float
    iterations: int

    @property
    def coefficients(self) -> dict[str, float]:
        return {f: b / s for f, b, s in zip(self.features, self.beta, self.std)}

    def score(self, units: DataFrame, name: str = "hazard") -> DataFrame:
        """Log partial hazard; larger means earlier failure."""
        total = F.lit(0.0)
        for f, m, s, b in zip(self.features, self.mean, self.std, self.beta):
            total = total + (F.col(f) - F.lit(m)) / F.lit(s) * F.lit(b)
        return units.withColumn(name, total)


def _pair_count(p: int) -> int:
    return p * (p + 1) // 2


def _moments(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Rows of [w, w x, upper triangle of w x x'] for every reading."""
    upper = np.triu_indices(x.shape[1])
    return np.hstack(
        [weight[:, None], x * weight[:, None], x[:, upper[0]] * x[:, upper[1]] * weight[:, None]]
    )


def _duration_moments(units: DataFrame, beta: np.ndarray) -> DataFrame:
    """Per distinct duration: moments of all units and of failing units, failures and their
    covariate sum. Partitions are reduced before the shuffle."""
    p = len(beta)

    def reduce_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(len(batch), p)
            weight = np.exp(x @ beta)
            event = batch["event"].to_numpy(dtype=float)
            all_rows = _moments(x, weight)
            packed = np.hstack([all_rows, all_rows * event[:, None], event[:, None], x * event[:, None]])
            times, place = np.unique(batch["duration"].to_numpy(), return_inverse=True)
            sums = np.zeros((len(times), packed.shape[1]))
            np.add.at(sums, place, packed)
            yield pd.DataFrame({"duration": times, "sums": list(sums)})

    partial = units.select("duration", "event", "x").mapInPandas(
        reduce_partition, "duration double, sums array<double>"
    )
    return partial.groupBy("duration").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")
    )


def _unpack(flat: np.ndarray, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    second = np.zeros((p, p))
    second[np.triu_indices(p)] = flat[1 + p :]
    return flat[0], flat[1 : 1 + p], second + np.triu(second, 1).T


def _tie_sums(s0: float, e0: float, ties: int) -> tuple[float, float, float, float, float, float]:
    """Sums over tied failures of the terms of the Efron likelihood, in bounded pieces."""
    out = np.zeros(6)
    for start in range(0, ties, 1_000_000):
        share = np.arange(start, min(ties, start + 1_000_000)) / ties
        rest = s0 - share * e0
        a = 1.0 / rest
        b = share * a
        out += [np.log(rest).sum(), a.sum(), b.sum(), (a * a).sum(), (a * b).sum(), (b * b).sum()]
    return tuple(out)


def _block_terms(rows: pd.DataFrame, later: np.ndarray, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Likelihood, gradient and information of one block of durations, given the moments of
    all later ones."""
    p = len(beta)
    m = 1 + p + _pair_count(p)
    risk = np.array(later, dtype=float)
    value, gradient, information = 0.0, np.zeros(p), np.zeros((p, p))
    for sums in rows.sort_values("duration", ascending=False)["sums"]:
        sums = np.asarray(sums, dtype=float)
        risk += sums[:m]
        ties = int(round(sums[2 * m]))
        if ties == 0:
            continue
        failing_x = sums[2 * m + 1 :]
        s0, s1, s2 = _unpack(risk, p)
        e0, e1, e2 = _unpack(sums[m : 2 * m], p)
        logs, a, b, aa, ab, bb = _tie_sums(s0, e0, ties)
        value += failing_x @ beta - logs
        gradient += failing_x - (a * s1 - b * e1)
        outer = aa * np.outer(s1, s1) - ab * (np.outer(s1, e1) + np.outer(e1, s1)) + bb * np.outer(e1, e1)
        information += a * s2 - b * e2 - outer
    return value, gradient, information


_BLOCKS = 128


def _newton_terms(units: DataFrame, beta: np.ndarray, low: float, high: float):
    """One pass over the units. Durations are cut into blocks; only block totals and block
    results reach the driver."""
    p = len(beta)
    m = 1 + p + _pair_count(p)
    width = max((high - low) / _BLOCKS, 1e-12)
    block = F.least(F.floor((F.col("duration") - F.lit(low)) / F.lit(width)), F.lit(_BLOCKS - 1))
    table = pinned(_duration_moments(units, beta).withColumn("block", block.cast("int")))
    totals = table.groupBy("block").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.slice("sums", 1, m)))).alias("total")
    )
    later: dict[int, np.ndarray] = {}
    running_total = np.zeros(m)
    for row in sorted(totals.collect(), key=lambda r: -r["block"]):  # at most _BLOCKS rows
        later[row["block"]] = running_total.copy()
        running_total += np.asarray(row["total"])

    def block_terms(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        value, gradient, information = _block_terms(rows, later[key[0]], beta)
        return pd.DataFrame(
            {"value": [value], "gradient": [gradient], "information": [information.ravel()]}
        )

    terms = table.groupBy("block").applyInPandas(
        block_terms, "value double, gradient array<double>, information array<double>"
    ).collect()  # one row per block
    value = sum(t["value"] for t in terms)
    gradient = np.sum([t["gradient"] for t in terms], axis=0)
    information = np.sum([t["information"] for t in terms], axis=0).reshape(p, p)
    return value, gradient, information


def fit_cox(
    units: DataFrame, features: Sequence[str], penalizer: float = PENALIZER, iterations: int = 25,
    tolerance: float = 1e-7, top: int = MAX_FEATURES,
) -> CoxModel:
    """Ridge-penalised partial likelihood with Efron ties, maximised by damped Newton steps.

    Features of (near) zero variance are dropped and the `top` by variance kept. Every step
    reduces the units to moments per distinct duration, so data size enters only there.
    """
    chosen = [r["feature"] for r in varying_features(units, features, MIN_VARIANCE, top).collect()]
    names = [f for f in features if f in chosen]
    stats = units.agg(
        *[F.avg(f).alias(f"m_{f}") for f in names], *[F.stddev_samp(f).alias(f"s_{f}") for f in names],
        F.min("duration").alias("low"), F.max("duration").alias("high"), F.count(F.lit(1)).alias("n"),
    ).first()
    mean, std = [stats[f"m_{f}"] for f in names], [stats[f"s_{f}"] for f in names]
    x = F.array(*[(F.col(f) - F.lit(m)) / F.lit(s) for f, m, s in zip(names, mean, std)])
    table = pinned(
        units.select(F.col("duration").cast("double").alias("duration"), "event", x.alias("x"))
    )
    n, p = stats["n"], len(names)
    low, high = float(stats["low"]), float(stats["high"])

    def objective(b):
        value, gradient, information = _newton_terms(table, b, low, high)
        return (
            value / n - 0.5 * penalizer * b @ b,
            gradient / n - penalizer * b,
            information / n + penalizer * np.eye(p),
            value,
        )

    beta = np.zeros(p)
    current = objective(beta)
    steps = 0
    for steps in range(1, iterations + 1):
        direction = np.linalg.solve(current[2], current[1])
        if current[1] @ direction < tolerance:
            break
        scale = 1.0
        while True:
            trial = objective(beta + scale * direction)
            if trial[0] >= current[0] or scale < 1e-4:
                break
            scale /= 2.0
        beta, current = beta + scale * direction, trial
    return CoxModel(names, mean, std, beta.tolist(), float(current[3]), steps)


def concordance(
    units: DataFrame, groups: Sequence[str] = (), duration: str = "duration", event: str = "event",
    risk: str = "hazard", weight: Column | None = None,
) -> DataFrame:
    """Share of comparable pairs where the earlier failure has the higher risk; ties count half.

    A pair is comparable if the earlier time is a failure, or the times agree and only one is.
    Pairs are counted, never built: two risks differ first at some bit of their rank, so within
    each (bit, higher bits) group the pairs are failures with the bit set against later units
    without it. Rows enter once per bit, already reduced to counts per rank and duration.
    """
    w = weight if weight is not None else F.lit(1)
    base = units.select(
        *groups, F.col(duration).cast("double").alias("_t"), (F.col(event) == 1).alias("_failed"),
        F.col(risk).cast("double").alias("_risk"), w.cast("double").alias("_w"),
    )
    cells = base.groupBy(*groups, "_risk", "_t").agg(
        F.sum(F.when(F.col("_failed"), F.col("_w")).otherwise(0.0)).alias("_f"),
        F.sum(F.when(F.col("_failed"), 0.0).otherwise(F.col("_w"))).alias("_c"),
    )
    levels = cells.select(*groups, "_risk").distinct().withColumn("_one", F.lit(1).cast("bigint"))
    ranks = running(levels, groups, "_risk", {"_rank": "_one"}).select(*groups, "_risk", "_rank")
    ranked = pinned(cells.join(ranks, [*groups, "_risk"]).drop("_risk"))
    deepest = ranked.agg(F.max("_rank")).first()[0] or 1
    bits = max(1, int(deepest).bit_length())
    rank = F.col("_rank")
    entries = [
        F.struct(F.lit(-2).alias("_level"), F.lit(0).cast("bigint").alias("_prefix"),
                 F.lit(1).alias("_high"), F.lit(1).alias("_low")),
        F.struct(F.lit(-1).alias("_level"), rank.alias("_prefix"),
                 F.lit(1).alias("_high"), F.lit(1).alias("_low")),
        *[
            F.struct(
                F.lit(b).alias("_level"), F.shiftright(rank, b + 1).alias("_prefix"),
                F.shiftright(rank, b).bitwiseAND(1).cast("int").alias("_high"),
                (1 - F.shiftright(rank, b).bitwiseAND(1)).cast("int").alias("_low"),
            )
            for b in range(bits)
        ],
    ]
    spread = ranked.select(*groups, "_t", "_f", "_c", F.inline(F.array(*entries)))
    keys = [*groups, "_level", "_prefix"]
    reduced = spread.groupBy(*keys, "_t").agg(
        F.sum(F.col("_f") * F.col("_high")).alias("_start"),
        F.sum((F.col("_f") + F.col("_c")) * F.col("_low")).alias("_any"),
        F.sum(F.col("_c") * F.col("_low")).alias("_open"),
    )
    placed = running(reduced, keys, "_t", {"_upto": "_any"}, {"_total": "_upto"})
    pairs = F.col("_start") * (F.col("_total") - F.col("_upto") + F.col("_open"))
    level = F.col("_level")
    return (
        placed.groupBy(*groups)
        .agg(
            F.sum(F.when(level >= 0, pairs).otherwise(0.0)).alias("concordant"),
            F.sum(F.when(level == -1, pairs).otherwise(0.0)).alias("tied"),
            F.sum(F.when(level == -2, pairs).otherwise(0.0)).alias("comparable"),
        )
        .withColumn(
            "c_index",
            (F.col("concordant") + 0.5 * F.col("tied")) / F.nullif(F.col("comparable"), F.lit(0.0)),
        )
    )


def bootstrap_weights(units: DataFrame, samples: int = BOOTSTRAPS, seed: int = SEED) -> DataFrame:
    """Resamples with replacement of exactly n units: every drawn unit with `sample` and the
    times it was drawn as `weight`. Draws are hashes of (sample, draw)."""
    spark = units.sparkSession
    order = key_hash(seed, text_key(F.col("variant")), F.col("unit_id"))
    indexed = _placed(units, [], order, KEYS)
    n = units.count()
    draws = spark.range(n * samples).select(
        F.floor(F.col("id") / n).cast("int").alias("sample"), (F.col("id") % n).alias("_draw")
    )
    pick = F.lit(1) + F.floor(key_uniform(seed + 100, F.col("sample"), F.col("_draw")) * n)
    counted = draws.groupBy("sample", pick.alias("_place")).agg(F.count(F.lit(1)).alias("weight"))
    return counted.join(indexed.drop("_size"), "_place").drop("_place")


def concordance_interval(
    units: DataFrame, risk: str = "hazard", samples: int = BOOTSTRAPS, seed: int = SEED
) -> DataFrame:
    """`c_index, ci_low, ci_high` from the bootstrap; NULL bounds below 10 valid samples."""
    small = pinned(units.select(*KEYS, "duration", "event", risk))
    drawn = pinned(bootstrap_weights(small, samples, seed))
    failures = drawn.groupBy("sample").agg(F.sum(F.col("event") * F.col("weight")).alias("_failures"))
    scores = pinned(concordance(drawn, ["sample"], risk=risk, weight=F.col("weight")))
    valid = scores.join(failures.where("_failures >= 2"), "sample").where("c_index IS NOT NULL")
    bounds = quantiles(valid, [], "c_index", {"ci_low": 0.025, "ci_high": 0.975})
    enough = F.col("n") >= MIN_VALID
    point = concordance(small, risk=risk).select("c_index")
    return bounds.select(
        point.scalar().alias("c_index"),
        F.when(enough, F.col("ci_low")).alias("ci_low"),
        F.when(enough, F.col("ci_high")).alias("ci_high"),
    )
