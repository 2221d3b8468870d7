"""Classification, calibration and regression metrics, grouped so that one job scores all models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.functions.ordering import histogram, running, weighted_quantiles
from fleetgauge.functions.scalars import linspace
from fleetgauge.operators.labels import capped
from fleetgauge.schema import RISK_THRESHOLD, RUL_CAP
from fleetgauge.session import pinned

# Precision target of the recall metric, penalty for late predictions, bins.
TARGET_PRECISION = 0.8
LATE_WEIGHT = 1.5
CALIBRATION_BINS = 10
RELIABILITY_BINS = 8


def score_histogram(
    df: DataFrame, groups: Sequence[str], y: str = "label_within_x", score: str = "risk"
) -> DataFrame:
    """Rows `n` and positives `pos` per distinct score: all that the metrics below need."""
    base = df.select(*groups, F.col(y).cast("int").alias("_y"), F.col(score).cast("double").alias("score"))
    return histogram(base, groups, "score", pos=F.col("_y").cast("bigint"))


def precision_recall_points(hist: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Curve points per distinct score, best score first: `threshold, precision, recall`."""
    ranked = running(
        hist.withColumn("_down", -F.col("score")),
        groups,
        "_down",
        {"_tp": "pos", "_flagged": "n"},
        {"_positives": "_tp"},
    )
    return ranked.select(
        *groups,
        F.col("score").alias("threshold"),
        (F.col("_tp") / F.col("_flagged")).alias("precision"),
        F.when(F.col("_positives") > 0, F.col("_tp") / F.col("_positives"))
        .otherwise(F.lit(1.0))
        .alias("recall"),
        F.when(F.col("_positives") > 0, F.col("pos") / F.col("_positives"))
        .otherwise(F.lit(0.0))
        .alias("recall_step"),
    )


def ranking_metrics(
    hist: DataFrame, groups: Sequence[str], target_precision: float = TARGET_PRECISION
) -> DataFrame:
    """Stepwise average precision and the best recall at the target precision (0 if unreached)."""
    reached = F.when(F.col("precision") >= target_precision, F.col("recall"))
    return precision_recall_points(hist, groups).groupBy(*groups).agg(
        F.sum(F.col("recall_step") * F.col("precision")).alias("pr_auc"),
        F.coalesce(F.max(reached), F.lit(0.0)).alias("recall_at_p80"),
    )


def _f1(hist_pos: Column, hist_n: Column, flagged: Column) -> Column:
    tp = F.sum(F.when(flagged, hist_pos).otherwise(0))
    fp = F.sum(F.when(flagged, hist_n - hist_pos).otherwise(0))
    fn = F.sum(F.when(flagged, 0).otherwise(hist_pos))
    return F.coalesce(2.0 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), F.lit(0.0))


def threshold_metrics(
    hist: DataFrame, groups: Sequence[str], threshold: float = RISK_THRESHOLD
) -> DataFrame:
    """F1 at the threshold and Brier score."""
    pos, n, s = F.col("pos"), F.col("n"), F.col("score")
    squared = pos * (s - 1.0) * (s - 1.0) + (n - pos) * s * s
    return hist.groupBy(*groups).agg(
        _f1(pos, n, s >= threshold).alias("f1"), (F.sum(squared) / F.sum(n)).alias("brier_score")
    )


def _edge_bin(value: Column, bins: int) -> Column:
    """Index of the half-open bin, compared against the raw edges so that edge values agree."""
    passed = F.lit(0)
    for edge in linspace(0.0, 1.0, bins + 1):
        passed = passed + (value >= F.lit(edge)).cast("int")
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), passed - 1))


def calibration_bins(
    hist: DataFrame, groups: Sequence[str], bins: int = CALIBRATION_BINS
) -> DataFrame:
    """Non-empty uniform bins with count, positive rate and mean score."""
    return (
        hist.withColumn("bin", _edge_bin(F.col("score"), bins))
        .groupBy(*groups, "bin")
        .agg(
            F.sum("n").alias("n"),
            (F.sum("pos") / F.sum("n")).alias("positive_rate"),
            (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_score"),
        )
    )


def calibration_error(
    hist: DataFrame, groups: Sequence[str], bins: int = CALIBRATION_BINS
) -> DataFrame:
    """Expected calibration error over uniform bins."""
    gap = F.col("n") * F.abs(F.col("positive_rate") - F.col("mean_score"))
    return calibration_bins(hist, groups, bins).groupBy(*groups).agg(
        (F.sum(gap) / F.sum("n")).alias("ece")
    )


def classification_metrics(
    df: DataFrame,
    groups: Sequence[str],
    y: str = "label_within_x",
    score: str = "risk",
    threshold: float = RISK_THRESHOLD,
) -> DataFrame:
    """`pr_auc, recall_at_p80, f1, brier_score, ece` per group, from one score histogram, written once."""
    if not groups:
        whole = df.withColumn("_all", F.lit("all"))
        return classification_metrics(whole, ["_all"], y, score, threshold).drop("_all")
    hist = pinned(score_histogram(df, groups, y, score))
    return (
        ranking_metrics(hist, groups)
        .join(threshold_metrics(hist, groups, threshold), list(groups))
        .join(calibration_error(hist, groups), list(groups))
    )


def regression_metrics(
    df: DataFrame, groups: Sequence[str], actual: str = "rul", predicted: str = "predicted_rul"
) -> DataFrame:
    """`mae, rmse, asymmetric_penalty` per group; late predictions weigh more."""
    error = F.col(predicted).cast("double") - F.col(actual).cast("double")
    weight = F.when(error > 0, F.lit(LATE_WEIGHT)).otherwise(F.lit(1.0))
    return df.groupBy(*groups).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(weight * F.abs(error)).alias("asymmetric_penalty"),
    )


def truth_errors(predictions: DataFrame, truth: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw and capped errors of one prediction per unit against the truth vector."""
    both = predictions.join(truth, list(keys)).withColumns(
        {"_p": capped("predicted_rul", RUL_CAP), "_t": capped("true_rul", RUL_CAP)}
    )
    raw = F.col("predicted_rul") - F.col("true_rul")
    cut = F.col("_p") - F.col("_t")
    return both.agg(
        F.count(F.lit(1)).alias("n_units"),
        F.avg(F.abs(raw)).alias("mae"),
        F.sqrt(F.avg(raw * raw)).alias("rmse"),
        F.avg(F.abs(cut)).alias("mae_capped"),
        F.sqrt(F.avg(cut * cut)).alias("rmse_capped"),
    )


def reliability_curve(
    df: DataFrame, y: str = "label_within_x", score: str = "risk", bins: int = RELIABILITY_BINS
) -> DataFrame:
    """Mean score and positive rate in quantile bins; empty bins are left out."""
    hist = score_histogram(df, [], y, score)
    levels = {f"q{i}": p for i, p in enumerate(linspace(0.0, 1.0, bins + 1))}
    edges = weighted_quantiles(hist, [], "score", levels)
    passed = F.lit(0)
    for i in range(1, bins):
        passed = passed + (F.col("score") > edges.select(f"q{i}").scalar()).cast("int")
    return (
        hist.withColumn("bin", passed)
        .groupBy("bin")
        .agg(
            F.sum("n").alias("n"),
            (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_score"),
            (F.sum("pos") / F.sum("n")).alias("positive_rate"),
        )
    )


def confusion_matrix(
    df: DataFrame, y: str = "label_within_x", score: str = "risk", threshold: float = RISK_THRESHOLD
) -> DataFrame:
    """The full 2x2 grid `(actual, predicted, n)`."""
    actual, flagged = F.col(y) == 1, F.col(score) >= threshold
    row = df.agg(
        *[
            F.sum(((actual == bool(a)) & (flagged == bool(p))).cast("bigint")).alias(f"_{a}{p}")
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                 F.coalesce(F.col(f"_{a}{p}"), F.lit(0)).alias("n"))
        for a in (0, 1)
        for p in (0, 1)
    ]
    return row.select(F.inline(F.array(*cells)))


def interval_coverage(
    df: DataFrame, groups: Sequence[str], actual: str, low: str, high: str
) -> DataFrame:
    """Share of actual values inside the interval and its mean width, over the `n` rows that have an
    actual value and both bounds; `n_without` counts the others."""
    inside = F.col(actual).between(F.col(low), F.col(high))
    return df.groupBy(*groups).agg(
        F.count(inside).alias("n"),
        F.count_if(inside.isNull()).alias("n_without"),
        F.avg(inside.cast("double")).alias("coverage"),
        F.avg(F.when(inside.isNotNull(), F.col(high) - F.col(low))).alias("mean_width"),
    )


def monotone_violations(table: DataFrame, order: str, falling: str, rising: str) -> DataFrame:
    """Steps of a small sweep table where `falling` rises or `rising` falls."""
    w = Window.orderBy(order)
    bad = (F.col(falling) > F.lag(falling).over(w)) | (F.col(rising) < F.lag(rising).over(w))
    return table.withColumn("_bad", bad).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.coalesce(F.sum(F.col("_bad").cast("bigint")), F.lit(0)).alias("n_violations"),
    )
