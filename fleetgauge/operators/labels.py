"""Remaining-useful-life and failure-horizon labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from fleetgauge.functions.ordering import oversized
from fleetgauge.functions.scalars import clip
from fleetgauge.schema import CYCLE, HORIZON, KEYS, RUL_CAP


def per_unit(df: DataFrame, hot: bool | None = None, **aggregates) -> DataFrame:
    """Add per-unit aggregates to every row.

    Units of bounded size use a window, which shares its exchange with later unit windows;
    otherwise the aggregate is computed map-side first and joined, so no task holds a unit.
    """
    if hot is None:
        hot = oversized(df, KEYS)
    if not hot:
        w = Window.partitionBy(*KEYS)
        return df.withColumns({name: agg.over(w) for name, agg in aggregates.items()})
    stats = df.groupBy(*KEYS).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return df.join(stats, KEYS)


def add_rul(df: DataFrame, hot: bool | None = None) -> DataFrame:
    """Cycles left until the last recorded cycle of the unit (run-to-failure data)."""
    out = per_unit(df, hot, _end=F.max(CYCLE))
    return out.withColumn("rul", (F.col("_end") - F.col(CYCLE)).cast("int")).drop("_end")


def add_rul_from_truth(df: DataFrame, truth: DataFrame, hot: bool | None = None) -> DataFrame:
    """Label truncated series from `(variant, unit_id, true_rul)`, the life left at the last row."""
    out = per_unit(df, hot, _end=F.max(CYCLE)).join(truth, KEYS)
    return out.withColumn(
        "rul", (F.col("true_rul") + F.col("_end") - F.col(CYCLE)).cast("int")
    ).drop("_end", "true_rul")


def add_binary_label(df: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """1 when the unit fails within `horizon` cycles."""
    if "rul" not in df.columns:
        raise ValueError("column 'rul' is required; call add_rul first")
    return df.withColumn("label_within_x", (F.col("rul") <= horizon).cast("int"))


def capped(column: str, cap: float = RUL_CAP):
    """A remaining life bounded to [0, cap], used on both sides of a comparison."""
    return clip(F.col(column).cast("double"), 0.0, cap)
