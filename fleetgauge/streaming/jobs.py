"""Structured Streaming jobs: online scoring, stateful quality checks, event-time windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from fleetgauge.operators.models import score_risk
from fleetgauge.operators.policy import alerts
from fleetgauge.operators.quality import (
    FLATLINE_EPSILON, FLATLINE_WINDOW, SPIKE_THRESHOLD, SPIKE_WINDOW,
)
from fleetgauge.operators.rules import Range, SERVING_RULES, mark_valid
from fleetgauge.operators.uncertainty import add_flag, add_risk_interval, add_rul_fallback
from fleetgauge.schema import CYCLE, KEYS


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive; the batch size bounds what one trigger holds."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(
    df: DataFrame, target: str, checkpoint: str, partition: Sequence[str] = (), idle_batches: bool = True
) -> None:
    """Process what is there, append exactly once to parquet, and stop. State is kept in RocksDB, outside
    the heap. `idle_batches` lets triggers without data follow, which a watermark needs to give its last
    rows; with processing-time timers there would be no end of them. The session's own settings are put
    back afterwards."""
    conf = df.sparkSession.conf
    wanted = {_STORE: _ROCKS, _NO_DATA: str(idle_batches).lower()}
    before = {name: conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        if partition:
            writer = writer.partitionBy(*partition)
        writer.trigger(availableNow=True).start(target).awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def without_replays(readings: DataFrame, time: str, delay: str, keys: Sequence[str] = (*KEYS, CYCLE)) -> DataFrame:
    """One row per key of a stream that may deliver rows again within `delay` of event time; state older
    than that is dropped. `time`: a timestamp column."""
    return readings.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def model_score(model: PipelineModel, features: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Scores of a fitted classifier for `score_stream`; the model's stages run inside the stream."""
    return lambda df: score_risk(model, df, features)


def score_stream(
    readings: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    rules: Sequence[Range] = SERVING_RULES,
    q_hat: float | None = None,
    reference_date: dt.date | None = None,
    keep: Sequence[str] = (*KEYS, CYCLE),
) -> DataFrame:
    """Online path: validity, risk, interval, flag and alert for every reading, without state.

    `score` adds `risk` (and `predicted_rul` if it can). Rows that break a rule stay in the
    output with `is_valid` false and no alert, so a sink can be partitioned by it.
    """
    scored = add_flag(add_risk_interval(add_rul_fallback(score(mark_valid(readings, rules))), q_hat))
    carried = [*keep, "is_valid", "replace_within_30", "risk_lower", "risk_upper"]
    out = alerts(scored, reference_date=reference_date, keep=carried)
    hidden = [c for c in out.columns if c not in (*keep, "is_valid")]
    return out.withColumns({c: F.when(F.col("is_valid"), F.col(c)) for c in hidden})


#: A reading's flags; `event` is reading, late or expired, `late_rows` the unit's late readings so far.
FLAGS = T.StructType(
    [
        T.StructField("variant", T.StringType()),
        T.StructField("unit_id", T.LongType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("cycle", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("is_flat", T.BooleanType()),
        T.StructField("missing_rate", T.DoubleType()),
        T.StructField("is_spike", T.BooleanType()),
    ]
)
_HELD = max(FLATLINE_WINDOW, SPIKE_WINDOW) - 1


def _trailing_view(values: np.ndarray, window: int, start: int, fill: float) -> np.ndarray:
    padded = np.concatenate([np.full(window - 1, fill), values])
    return np.lib.stride_tricks.sliding_window_view(padded, window)[start:]


def _window_flags(values: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Trailing deviation and missing share of the readings from `start` on."""
    frames = _trailing_view(values, FLATLINE_WINDOW, start, np.nan)
    seen = ~np.isnan(frames)
    count = seen.sum(axis=1)
    mean = np.where(seen, frames, 0.0).sum(axis=1) / np.maximum(count, 1)
    squares = np.where(seen, frames - mean[:, None], 0.0) ** 2
    std = np.sqrt(squares.sum(axis=1) / np.maximum(count - 1, 1))
    std[count < max(2, FLATLINE_WINDOW // 2)] = np.nan
    missing = _trailing_view(np.isnan(values).astype(float), SPIKE_WINDOW, start, 0.0)
    length = np.minimum(np.arange(start, len(values)) + 1, SPIKE_WINDOW)
    return std, missing.sum(axis=1) / length


_IDLE_MS = 7 * 24 * 3600 * 1000
_SPARE_MS = 24 * 3600 * 1000


class QualityTracker(StatefulProcessor):
    """Flags for one (variant, unit, sensor). State: the last cycle with the count of late readings and
    the timer set (`last`), and the readings that later frames reach back to (`recent`). With an
    idle time a timer ends a silent unit's state with a row of its own, and state that no timer
    has ended is dropped without one `_SPARE_MS` later."""

    def __init__(self, idle_ms: int | None):
        self._idle = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        kept = None if self._idle is None else self._idle + _SPARE_MS
        self._last = handle.getValueState("last", "cycle bigint, late bigint, timer bigint", kept)
        self._recent = handle.getListState("recent", "value double", kept)

    def _rows(self, key: tuple, cycles: np.ndarray, event: str, late: int, **flags) -> pd.DataFrame:
        n = len(cycles)
        blank = {"is_flat": [None] * n, "missing_rate": [np.nan] * n, "is_spike": [None] * n}
        named = {"variant": [key[0]] * n, "unit_id": [key[1]] * n, "sensor": [key[2]] * n, "cycle": cycles,
                 "event": [event] * n, "late_rows": [late] * n}
        return pd.DataFrame(named | blank | flags)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        seen = self._last.get() if self._last.exists() else None
        last, late, timer = seen if seen is not None else (None, 0, None)
        recent = np.array([r[0] for r in self._recent.get()] if self._recent.exists() else [], float)
        parts = [(r["cycle"].to_numpy(np.int64), r["value"].to_numpy(float)) for r in rows]  # a trigger's rows of one unit
        cycles, values = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(cycles, kind="stable")
        cycles, values = cycles[order], values[order]
        fresh = np.r_[True, cycles[1:] != cycles[:-1]]
        if last is not None:
            fresh &= cycles > last
        late += int((~fresh).sum())
        if fresh.any():
            joined = np.concatenate([recent, values[fresh]])
            std, rate = _window_flags(joined, len(recent))
            yield self._rows(key, cycles[fresh], "reading", late, is_flat=std < FLATLINE_EPSILON, missing_rate=rate, is_spike=rate > SPIKE_THRESHOLD)
            last = int(cycles[fresh][-1])
            self._recent.put([(float(v),) for v in joined[-_HELD:]])
        if not fresh.all():
            yield self._rows(key, cycles[~fresh], "late", late)
        if self._idle is not None:
            if timer is not None:
                self._handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + self._idle
            self._handle.registerTimer(timer)
        self._last.update((last, late, timer))

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self._last.exists():  # dropped meanwhile
            return
        last, late, _ = self._last.get()
        self._last.clear()
        self._recent.clear()
        yield self._rows(key, np.array([last]), "expired", late)

    def close(self) -> None:
        pass


def quality_stream(readings: DataFrame, sensors: Sequence[str], idle_ms: int | None = _IDLE_MS) -> DataFrame:
    """Flatline and missing-spike flags per reading of a stream (FLAGS); equal to the batch windows on
    input in cycle order. Readings at or before the last seen cycle, and repeats of a cycle, are events
    `late` without flags. State is kept per (unit, sensor); a unit silent for `idle_ms` (None: never)
    gives an event `expired` and starts anew. A task holds one unit's readings of one trigger. The
    session must keep state in RocksDB (`run_available` sees to it)."""
    ids = [*KEYS, CYCLE]
    tall = readings.select(
        "variant", F.col("unit_id").cast("bigint").alias("unit_id"), F.col(CYCLE).cast("bigint").alias(CYCLE),
        *[F.col(s).cast("double").alias(s) for s in sensors],
    ).unpivot(ids, list(sensors), "sensor", "value")
    mode = "None" if idle_ms is None else "ProcessingTime"
    return tall.groupBy(*KEYS, "sensor").transformWithStateInPandas(QualityTracker(idle_ms), FLAGS, "append", mode)


def windowed_readings(
    events: DataFrame, kind: str, time: str = "ts", value: str = "value", keys: Sequence[str] = (),
    length: str = "1 hour", slide: str | None = None, gap: str = "30 minutes",
    delay: str | None = None,
) -> DataFrame:
    """Count and mean per tumbling, sliding or session window; works on batch and stream.
    `delay` is the watermark of a stream."""
    df = events.withColumn(time, F.col(time).cast("timestamp"))
    if delay:
        df = df.withWatermark(time, delay)
    if kind == "tumbling":
        frame = F.window(time, length)
    elif kind == "sliding":
        frame = F.window(time, length, slide or length)
    elif kind == "session":
        frame = F.session_window(time, gap)
    else:
        raise ValueError("kind must be tumbling, sliding or session")
    return df.groupBy(frame.alias("frame"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")
    ).select(F.col("frame.start").alias("start"), F.col("frame.end").alias("end"), *keys, "n", "mean_value")
