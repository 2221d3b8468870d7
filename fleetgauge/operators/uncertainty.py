"""Conformal and residual-quantile intervals around predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fleetgauge.functions.ordering import quantiles
from fleetgauge.functions.scalars import clip
from fleetgauge.schema import ALPHA, MAX_RUL, QUANTILE_HIGH, QUANTILE_LOW, RISK_THRESHOLD


def conformal_level(n: Column, alpha: float) -> Column:
    """Finite-sample corrected level, clipped to [0, 1]."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.ceil((n + 1) * F.lit(1.0 - alpha)) / n))


def conformal_width(
    df: DataFrame, groups: Sequence[str] = (), y: str = "label_within_x", score: str = "risk",
    alpha: float = ALPHA,
) -> DataFrame:
    """`(alpha, q_hat)` per group: the corrected quantile of 1 - p(true class)."""
    p = F.col(score).cast("double")
    miss = F.when(F.col(y) == 1, 1.0 - p).otherwise(1.0 - (1.0 - p))
    base = df.select(*groups, miss.alias("_miss"))
    out = quantiles(base, groups, "_miss", {"q_hat": lambda n: conformal_level(n, alpha)})
    return out.select(*groups, F.lit(alpha).alias("alpha"), "q_hat")


def add_risk_interval(df: DataFrame, q_hat: float | Column | None, score: str = "risk") -> DataFrame:
    """`risk_lower, risk_upper`; NULL without a calibration artifact. `q_hat` may be a column, for widths
    by group."""
    if q_hat is None:
        none = F.lit(None).cast("double")
        return df.withColumns({"risk_lower": none, "risk_upper": none})
    p = F.col(score).cast("double")
    return df.withColumns(
        {"risk_lower": clip(p - q_hat, 0.0, 1.0), "risk_upper": clip(p + q_hat, 0.0, 1.0)}
    )


def add_rul_fallback(df: DataFrame, score: str = "risk", max_rul: float = MAX_RUL) -> DataFrame:
    """Fill `predicted_rul` from the risk where no regressor gave one; never below 0."""
    guess = (1.0 - F.col(score).cast("double")) * max_rul
    known = F.col("predicted_rul").cast("double") if "predicted_rul" in df.columns else None
    value = F.coalesce(clip(known, 0.0), guess) if known is not None else guess
    return df.withColumn("predicted_rul", value)


def add_flag(df: DataFrame, score: str = "risk", threshold: float = RISK_THRESHOLD) -> DataFrame:
    return df.withColumn("replace_within_30", F.col(score) >= threshold)


def _bucket(width: float) -> Column:
    return F.floor(F.col("predicted_rul") / F.lit(width)).cast("bigint")


def residual_quantiles(
    calibration: DataFrame, low: float = QUANTILE_LOW, high: float = QUANTILE_HIGH,
    width: float = 50.0, groups: Sequence[str] = (),
) -> DataFrame:
    """Residual quantiles per bucket of the predicted value (split conformal per bucket)."""
    base = calibration.select(
        *groups, _bucket(width).alias("bucket"),
        (F.col("rul").cast("double") - F.col("predicted_rul")).alias("_residual"),
    )
    return quantiles(base, [*groups, "bucket"], "_residual", {"shift_low": low, "shift_high": high})


def overall_quantiles(
    calibration: DataFrame, low: float = QUANTILE_LOW, high: float = QUANTILE_HIGH, groups: Sequence[str] = ()
) -> DataFrame:
    """Residual quantiles over all buckets, for predictions in buckets that calibration lacks."""
    residual = (F.col("rul").cast("double") - F.col("predicted_rul")).alias("_residual")
    base = calibration.select(*groups, F.lit(0).alias("_all"), residual)
    found = quantiles(base, [*groups, "_all"], "_residual", {"all_low": low, "all_high": high})
    return found.drop("n")


def add_rul_interval(
    df: DataFrame, shifts: DataFrame | None, width: float = 50.0, groups: Sequence[str] = (),
    overall: DataFrame | None = None,
) -> DataFrame:
    """`rul_lower, rul_upper`, not below 0; NULL without calibration. A bucket unseen in calibration
    takes the quantiles of `overall` (`overall_quantiles`); without them it stays NULL."""
    if shifts is None:
        none = F.lit(None).cast("double")
        return df.withColumns({"rul_lower": none, "rul_upper": none})
    keys = [*groups, "bucket"]
    out = df.withColumn("bucket", _bucket(width)).join(shifts.drop("n"), keys, "left")
    p = F.col("predicted_rul")
    if overall is not None:
        out = out.withColumn("_all", F.lit(0)).join(overall, [*groups, "_all"], "left")
        out = out.withColumns({f"shift_{e}": F.coalesce(f"shift_{e}", f"all_{e}") for e in ("low", "high")})
        out = out.drop("_all", "all_low", "all_high")
    return out.withColumns(
        {
            "rul_lower": clip(p + F.col("shift_low"), 0.0),
            "rul_upper": clip(p + F.col("shift_high"), 0.0),
        }
    ).drop("bucket", "shift_low", "shift_high")


def pass_statistics(passes: DataFrame, keys: Sequence[str], score: str = "risk") -> DataFrame:
    """Mean and population deviation over stochastic passes or ensemble members."""
    s = F.col(score).cast("double")
    return passes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_passes"),
        F.avg(s).alias("risk_mean"),
        F.stddev_pop(s).alias("risk_std"),
    )
