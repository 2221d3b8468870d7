"""Leakage-free splits and train-only scaling."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.functions.ordering import histogram, running
from fleetgauge.functions.scalars import key_hash
from fleetgauge.schema import CYCLE, KEYS, SEED, TRAIN_RATIO
from fleetgauge.session import pinned

# Spread below this share of the mean counts as a constant column.
CONSTANT_TOLERANCE = 1e-12
_SCALED_AT_ONCE = 14


class Scaler(NamedTuple):
    """Mean and population deviation per feature, fitted on the train side."""

    mean: dict[str, float]
    std: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.lit(self.mean[c]))
            / F.lit(self.std[c])
            for c in self.mean
        }
        return df.withColumns(scaled)


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame
    scaler: Scaler | None
    features: list[str]


def zero_filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.fillna(0.0, subset=list(features))


def scaler_statistics(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row: `{f}_mean` and `{f}_std` after zero fill, all columns in one pass."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    return df.agg(
        *[F.avg(x).alias(f"{c}_mean") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"{c}_std") for c, x in filled.items()],
    )


def fit_scaler(train: DataFrame, features: Sequence[str]) -> Scaler:
    """Fit the z-score; the result holds two numbers per feature. Few features a scan: an aggregate of
    more than a hundred numbers isn't compiled."""
    row = {}
    for i in range(0, len(features), _SCALED_AT_ONCE):
        row |= scaler_statistics(train, features[i : i + _SCALED_AT_ONCE]).first().asDict()
    mean = {c: float(row[f"{c}_mean"] or 0.0) for c in features}
    std = {}
    for c in features:
        s = float(row[f"{c}_std"] or 0.0)
        std[c] = 1.0 if s <= CONSTANT_TOLERANCE * max(1.0, abs(mean[c])) else s
    return Scaler(mean, std)


def _placed(
    units: DataFrame, groups: Sequence[str], order: Column, ties: Sequence[str]
) -> DataFrame:
    """Units with `_place` (1-based, per group) along a hash and `_size`, without a group window."""
    tagged = units.withColumn("_order", order)
    hist = histogram(tagged, groups, "_order")
    places = running(hist, groups, "_order", {"_upto": "n"}, {"_size": "_upto"})
    equal = Window.partitionBy(*groups, "_order").orderBy(*ties)
    return (
        tagged.join(places, [*groups, "_order"])
        .withColumn("_place", F.col("_upto") - F.col("n") + F.row_number().over(equal))
        .drop("_order", "_upto", "n")
    )


def units_of(df: DataFrame) -> DataFrame:
    return df.select(*KEYS).distinct()


def assign_units(df: DataFrame, ratio: float = TRAIN_RATIO, seed: int = SEED) -> DataFrame:
    """Per variant, exactly `int(n * ratio)` units go to train: `(variant, unit_id, is_train)`."""
    placed = _placed(units_of(df), ["variant"], key_hash(seed, F.col("unit_id")), ["unit_id"])
    is_train = F.col("_place") <= F.floor(F.col("_size") * F.lit(ratio))
    return placed.select(*KEYS, is_train.alias("is_train"))


def holdout_split(
    df: DataFrame, features: Sequence[str], ratio: float = TRAIN_RATIO, seed: int = SEED,
    scale: bool = True,
) -> Split:
    """Whole units to train or test, within each variant; scaler fitted on train only."""
    sides = pinned(assign_units(df, ratio, seed))  # one row per unit, used by both sides
    train = df.join(sides.where("is_train"), KEYS, "left_semi")
    test = df.join(sides.where("NOT is_train"), KEYS, "left_semi")
    return _scaled(train, test, features, scale)


def domain_split(
    df: DataFrame, features: Sequence[str], train_variants: Sequence[str] = ("FD001", "FD003"),
    test_variants: Sequence[str] = ("FD002", "FD004"), scale: bool = True,
) -> Split:
    """Train on some variants, test on others."""
    train = df.where(F.col("variant").isin(*train_variants))
    test = df.where(F.col("variant").isin(*test_variants))
    return _scaled(train, test, features, scale)


def _scaled(train, test, features, scale) -> Split:
    features = list(features)
    if not scale:
        return Split(train, test, None, features)
    scaler = fit_scaler(train, features)
    return Split(scaler.apply(train), scaler.apply(test), scaler, features)


def shared_units(left: DataFrame, right: DataFrame) -> DataFrame:
    """Units on both sides of a split; a leakage check expects none."""
    return units_of(left).intersect(units_of(right))


def validation_units(df: DataFrame, ratio: float = 0.1) -> DataFrame:
    """The first `max(1, int(ratio * n))` units per variant, by first cycle and then id."""
    starts = df.groupBy(*KEYS).agg(F.min(CYCLE).alias("_first"))
    placed = _placed(starts, ["variant"], F.col("_first"), ["unit_id"])
    wanted = F.greatest(F.lit(1), F.floor(F.col("_size") * F.lit(ratio)))
    return placed.where(F.col("_place") <= wanted).select(*KEYS)


def stratified_holdout(
    df: DataFrame, label: str = "label_within_x", ratio: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Add `is_holdout` for `round(ratio * n)` rows of every label value, chosen by row hash."""
    order = key_hash(seed, F.col("unit_id"), F.col(CYCLE))
    placed = _placed(df, [label], order, [*KEYS, CYCLE])
    wanted = F.bround(F.col("_size") * F.lit(ratio), 0)
    return placed.withColumn("is_holdout", F.col("_place") <= wanted).drop("_place", "_size")
