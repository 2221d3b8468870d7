"""Aggregates for exploring a fleet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import histogram, quantiles, running
from fleetgauge.schema import CYCLE, KEYS, SEED


def lifetimes(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(F.max(CYCLE).alias("lifetime"), F.count(F.lit(1)).alias("n_rows"))


def variant_summary(df: DataFrame) -> DataFrame:
    """Units, rows and shortest, longest and median life per variant."""
    lives = lifetimes(df)
    medians = quantiles(lives, ["variant"], "lifetime", {"median_cycles": 0.5}).drop("n")
    return (
        lives.groupBy("variant")
        .agg(
            F.count(F.lit(1)).alias("n_units"),
            F.sum("n_rows").alias("n_rows"),
            F.min("lifetime").alias("min_cycles"),
            F.max("lifetime").alias("max_cycles"),
        )
        .join(medians, "variant")
    )


def binned(
    df: DataFrame, value: str, groups: Sequence[str] = (), bins: int = 20
) -> DataFrame:
    """Equal-width histogram between each group's minimum and maximum; the last bin is closed."""
    hist = histogram(df, groups, value)
    bounds = hist.groupBy(*groups).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    if groups:
        bounded = hist.join(bounds, list(groups))
    else:
        bounded = hist.withColumns({c: bounds.select(c).scalar() for c in ("lo", "hi")})
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.floor((F.col(value) - F.col("lo")) / width)
    bin_ = F.when(width > 0, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return (
        bounded.withColumn("bin", bin_)
        .groupBy(*groups, "bin")
        .agg(
            F.min(F.col("lo") + F.col("bin") * width).cast("double").alias("bin_low"),
            F.sum("n").alias("n"),
        )
    )


def median_unit(df: DataFrame) -> DataFrame:
    """Per variant, the unit whose life is closest to the median, smallest id first."""
    lives = lifetimes(df)
    medians = quantiles(lives, ["variant"], "lifetime", {"median_cycles": 0.5}).drop("n")
    gap = F.abs(F.col("lifetime") - F.col("median_cycles"))
    return (
        lives.join(medians, "variant")
        .groupBy("variant")
        .agg(F.min_by("unit_id", F.struct(gap, F.col("unit_id"))).alias("unit_id"))
    )


def spearman(
    df: DataFrame, columns: Sequence[str], target: str = "rul", groups: Sequence[str] = (),
    minimum: int = 10,
) -> DataFrame:
    """Rank correlation of each column with `target` over rows where both are present.

    Works on the joint histogram of value pairs: ranks come from running counts of distinct
    values, so neither a constant column nor a large group meets in one task. Constant columns
    and fewer than `minimum` pairs give 0.
    """
    keys = [*groups, "sensor"]
    tall = (
        df.select(*groups, target, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([*groups, target], list(columns), "sensor", "_x")
        .where(F.col("_x").isNotNull() & F.col(target).isNotNull())
        .withColumn("_y", F.col(target).cast("double"))
    )
    pairs = tall.groupBy(*keys, "_x", "_y").agg(F.count(F.lit(1)).alias("n"))

    def ranks(value: str) -> DataFrame:
        hist = pairs.groupBy(*keys, value).agg(F.sum("n").alias("n"))
        placed = running(hist, keys, value, {"_upto": "n"}, {"_size": "_upto"})
        rank = F.col("_upto") - (F.col("n") - 1) / 2.0
        size = ["_size"] if value == "_y" else []
        return placed.select(*keys, value, *size, rank.alias(f"_r{value}"))

    joined = pairs.join(ranks("_x"), [*keys, "_x"]).join(ranks("_y"), [*keys, "_y"])
    mean = (F.col("_size") + 1) / 2.0
    dx, dy, n = F.col("_r_x") - mean, F.col("_r_y") - mean, F.col("n")
    sums = joined.groupBy(*keys).agg(
        F.max("_size").alias("n_pairs"),
        F.sum(n * dx * dy).alias("_xy"),
        F.sum(n * dx * dx).alias("_xx"),
        F.sum(n * dy * dy).alias("_yy"),
    )
    rho = F.col("_xy") / F.sqrt(F.nullif(F.col("_xx") * F.col("_yy"), F.lit(0.0)))
    valid = F.when(F.col("n_pairs") >= minimum, rho)
    return sums.select(*keys, "n_pairs", F.coalesce(valid, F.lit(0.0)).alias("rho"))


def best_sensor(correlations: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Sensor with the largest |rho|; the earlier column wins a tie."""
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("sensor"))
    strength = F.struct(F.abs(F.col("rho")), -order)
    return correlations.groupBy(*groups).agg(
        F.max_by("sensor", strength).alias("sensor"), F.max_by("rho", strength).alias("rho")
    )


def class_balance(df: DataFrame, label: str = "label_within_x") -> DataFrame:
    return df.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label)).alias("n_positive"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def missing_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of missing values per column, in one pass: `(feature, missing_rate)`."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return row.unpivot([], list(columns), "feature", "missing_rate")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(feature, mean, std_pop, std_samp, variance)` in one pass."""
    def packed(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("feature"),
            F.avg(x).alias("mean"),
            F.stddev_pop(x).alias("std_pop"),
            F.stddev_samp(x).alias("std_samp"),
            F.var_samp(x).alias("variance"),
        ).alias(c)

    row = df.agg(*[packed(c) for c in columns])
    return row.select(F.inline(F.array(*[F.col(c) for c in columns])))


def varying_features(
    df: DataFrame, columns: Sequence[str], minimum: float = 1e-8, top: int = 50
) -> DataFrame:
    """The `top` features by sample variance above `minimum`."""
    order = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("feature"))
    return (
        moments(df, columns)
        .where(F.col("variance") >= minimum)
        .orderBy(F.col("variance").desc(), order)
        .limit(top)
        .select("feature", "variance")
    )


def regimes(
    df: DataFrame, columns: Sequence[str] = ("op_setting_1", "op_setting_2"), k: int = 6,
    seed: int = SEED,
) -> DataFrame:
    """Operating regime per row: one-dimensional k-means bins of each setting, ordered by
    centre, and the larger bin of the row. Bin edges lie midway between centres."""
    bins = []
    for c in columns:
        x = F.col(c).cast("double")
        points = VectorAssembler(inputCols=[c], outputCol="_point", handleInvalid="skip").transform(
            df.select(x.alias(c))
        )
        model = KMeans(k=k, seed=seed, featuresCol="_point").fit(points.select("_point"))
        centres = sorted({float(v[0]) for v in model.clusterCenters()})
        edges = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
        place = F.lit(0)
        for edge in edges:
            place = place + (x >= F.lit(edge)).cast("int")
        bins.append(place)
    regime = F.greatest(*bins) if len(bins) > 1 else bins[0]
    return df.withColumn("op_regime", regime.cast("int"))
