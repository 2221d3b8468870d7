"""Frozen sensors and missing-value spikes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.functions.ordering import GROUP_ROWS, blocks
from fleetgauge.operators.features import rolling_std, trailing
from fleetgauge.schema import CYCLE, KEYS, sensor_columns

# Windows and cut-offs of the two checks, listed cycles per alert.
FLATLINE_WINDOW = 10
FLATLINE_EPSILON = 1e-4
SPIKE_WINDOW = 20
SPIKE_THRESHOLD = 0.05
LISTED_CYCLES = 20

_SERIES = [*KEYS, "sensor"]


def _flagged(
    df: DataFrame, sensors: Sequence[str] | None, window: int, hot: bool | None, rows: int,
    dense: bool, **flags
) -> DataFrame:
    """Long readings with window results; `flags` are functions of (value, window columns)."""
    sensors = sensor_columns(df.columns) if sensors is None else list(sensors)
    base = df.select(*KEYS, CYCLE, *sensors)
    framed, parts, finish = blocks(base, KEYS, CYCLE, window - 1, rows, hot, dense)
    if "_block" not in framed.columns:
        framed = framed.withColumns({"_block": F.lit(0).cast("bigint"), "_own": F.lit(0).cast("bigint")})
    ids = [*KEYS, CYCLE, "_block", "_own"]
    tall = framed.select(*ids, *sensors).unpivot(ids, list(sensors), "sensor", "value")
    series = [*_SERIES, "_block"]
    out = tall.withColumns({name: flag(F.col("value"), series) for name, flag in flags.items()})
    return out.where("_block = _own").drop("_own")


def _alerts(flagged: DataFrame, kind: str, extra: dict[str, Column]) -> DataFrame:
    """One alert per series: flagged cycles are counted and the first ones listed per block;
    only blocks that can contribute to the list keep theirs before the blocks meet."""
    listed = F.slice(F.array_sort(F.collect_list(F.when(F.col("_flag"), F.col(CYCLE)))), 1, LISTED_CYCLES)
    by_block = flagged.groupBy(*_SERIES, "_block").agg(
        F.sum(F.col("_flag").cast("bigint")).alias("_n"),
        listed.alias("_cycles"),
        *[column.alias(name) for name, column in extra.items()],
    )
    earlier = Window.partitionBy(*_SERIES).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    kept = by_block.withColumn("_cycles", F.when(seen < LISTED_CYCLES, F.col("_cycles")))
    total = kept.groupBy(*_SERIES).agg(
        F.sum("_n").alias("n_cycles"),
        *[F.max(name).alias(name) for name in extra],
        F.slice(F.array_sort(F.flatten(F.collect_list("_cycles"))), 1, LISTED_CYCLES).alias("cycles"),
    )
    return total.where("n_cycles > 0").withColumn("type", F.lit(kind)).select(
        "type", *_SERIES, "n_cycles", *extra, "cycles"
    )


def flatline_alerts(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    window: int = FLATLINE_WINDOW,
    epsilon: float = FLATLINE_EPSILON,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Series whose trailing deviation falls below `epsilon`."""
    still = lambda x, parts: F.coalesce(rolling_std(x, window, parts) < epsilon, F.lit(False))
    return _alerts(_flagged(df, sensors, window, hot, rows, dense, _flag=still), "flatline", {})


def spike_alerts(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    window: int = SPIKE_WINDOW,
    threshold: float = SPIKE_THRESHOLD,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Series whose trailing share of missing readings exceeds `threshold`."""
    rate = lambda x, parts: F.avg(x.isNull().cast("double")).over(trailing(parts, window))
    rated = _flagged(df, sensors, window, hot, rows, dense, _rate=rate)
    flagged = rated.withColumn("_flag", F.col("_rate") > threshold)
    return _alerts(flagged, "missing_spike", {"max_nan_rate": F.max("_rate")}).withColumn(
        "max_nan_rate", F.bround("max_nan_rate", 4)
    )


def quality_alerts(
    df: DataFrame, sensors: Sequence[str] | None = None, hot: bool | None = None,
    rows: int = GROUP_ROWS, dense: bool = False,
) -> DataFrame:
    """Both checks in one table; `max_nan_rate` is NULL for frozen sensors."""
    frozen = flatline_alerts(df, sensors, hot=hot, rows=rows, dense=dense)
    spikes = spike_alerts(df, sensors, hot=hot, rows=rows, dense=dense)
    return frozen.unionByName(spikes, allowMissingColumns=True)


def alert_totals(alerts: DataFrame) -> DataFrame:
    kind = F.col("type")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.coalesce(F.sum((kind == "flatline").cast("bigint")), F.lit(0)).alias("flatline_alerts"),
        F.coalesce(F.sum((kind == "missing_spike").cast("bigint")), F.lit(0)).alias(
            "missing_spike_alerts"
        ),
    )
