"""Rolling, trend, lag and sequence features per unit."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.functions.ordering import GROUP_ROWS, blocks
from fleetgauge.operators.rolling import add_assembled
from fleetgauge.schema import CYCLE, KEYS, LAGS, SEQUENCE_WINDOW, WINDOWS, sensor_columns


def trailing(parts: Sequence[str], window: int):
    """The last `window` rows of the partition up to the current one."""
    return Window.partitionBy(*parts).orderBy(CYCLE).rowsBetween(-(window - 1), 0)


def minimum_count(window: int) -> int:
    return max(1, window // 2)


def rolling_mean(x: Column, window: int, parts: Sequence[str]) -> Column:
    w = trailing(parts, window)
    return F.when(F.count(x).over(w) >= minimum_count(window), F.avg(x).over(w))


def rolling_std(x: Column, window: int, parts: Sequence[str]) -> Column:
    w = trailing(parts, window)
    return F.when(F.count(x).over(w) >= minimum_count(window), F.stddev_samp(x).over(w))


def rolling_slope(x: Column, position: Column, window: int, parts: Sequence[str]) -> Column:
    """Least-squares slope against row position; missing if any value of the frame is."""
    w = trailing(parts, window)
    whole = F.count(x).over(w) == F.count(F.lit(1)).over(w)
    enough = F.count(x).over(w) >= minimum_count(window)
    return F.when(enough & whole, F.regr_slope(x, position.cast("double")).over(w))


def lagged(x: Column, k: int, parts: Sequence[str]) -> Column:
    return F.lag(x, k).over(Window.partitionBy(*parts).orderBy(CYCLE))


# A window of up to this many base windows is assembled from base results.
_MAX_SEGMENTS = 8


def _base_window(windows: Sequence[int]) -> int | None:
    """The smallest window, if every other one is a small multiple of it."""
    if len(windows) < 2:
        return None
    base = min(windows)
    fits = all(w % base == 0 and w // base <= _MAX_SEGMENTS for w in windows)
    return base if fits else None


class _Stages(NamedTuple):
    """Columns to add one after the other, and helpers to drop at the end."""

    base: dict[str, Column]
    shifted: dict[str, Column]
    final: dict[str, Column]
    helpers: list[str]


def _direct(value: str, name: str, windows, lags, parts) -> _Stages:
    x, pos = F.col(value), F.col("_pos")
    out: dict[str, Column] = {}
    for w in windows:
        out[f"{name}_mean_w{w}"] = rolling_mean(x, w, parts)
        out[f"{name}_std_w{w}"] = rolling_std(x, w, parts)
        out[f"{name}_slope_w{w}"] = rolling_slope(x, pos, w, parts)
    for k in lags:
        out[f"{name}_lag{k}"] = lagged(x, k, parts)
    return _Stages(out, {}, {}, [])


def _places(windows: Sequence[int], base: int) -> dict[str, Column]:
    """Per window: its length at this row, the spread of positions in it, and the distance of
    each segment's middle from the window's middle. The same for all sensors."""
    out: dict[str, Column] = {}
    for window in windows:
        length = f"least({window}D, double(_pos))"
        out[f"_length{window}"] = F.expr(length)
        out[f"_spread{window}"] = F.expr(f"nullif({length} * ({length} * {length} - 1) / 12, 0D)")
        for j in range(window // base):
            rows = f"greatest(0D, least({base}D, double(_pos) - {j * base}))"
            out[f"_off{window}_{j}"] = F.expr(f"({length} - 1) / 2 - {j * base}D - ({rows} - 1) / 2")
    return out


def _assembled(value: str, name: str, windows, lags, parts, base: int) -> _Stages:
    """Frames are evaluated over the smallest window only. Longer windows combine its count,
    mean and centred moments with those of `base`, `2 base`, ... rows earlier, which costs a
    few lags in place of a second and third pass over 20 and 30 rows."""
    x, pos = F.col(value), F.col("_pos").cast("double")
    w = trailing(parts, base)
    n, m, v, c = (f"_{name}_{tag}" for tag in "nmvc")
    zero = F.lit(0.0)
    first = {
        n: F.count(x).over(w).cast("double"),
        m: F.coalesce(F.avg(x).over(w), zero),
        v: F.coalesce(F.var_pop(x).over(w), zero),
        c: F.coalesce(F.covar_pop(x, pos).over(w), zero),
        **{f"{name}_lag{k}": lagged(x, k, parts) for k in lags},
    }
    order = Window.partitionBy(*parts).orderBy(CYCLE)
    shifted = {
        f"{col}{j}": F.lag(col, j * base, 0.0).over(order)
        for j in range(1, max(windows) // base)
        for col in (n, m, v, c)
    }

    def part(col: str, j: int) -> str:
        return f"`{col}{j}`" if j else f"`{col}`"

    def total(term, js) -> str:
        return "(" + " + ".join(term(j) for j in js) + ")"

    final: dict[str, Column] = {}
    middle: dict[str, Column] = {}
    for window in windows:
        js = range(window // base)
        k, centre = f"`_{name}_count{window}`", f"`_{name}_mean{window}`"
        counted = total(lambda j: part(n, j), js)
        weighted = total(lambda j: f"{part(n, j)} * {part(m, j)}", js)
        one = len(js) == 1
        middle[k.strip("`")] = F.expr(counted)
        middle[centre.strip("`")] = F.expr(part(m, 0) if one else f"{weighted} / nullif({counted}, 0D)")

        def gap(j: int) -> str:
            return "0D" if one else f"({part(m, j)} - {centre})"

        def square(j: int) -> str:
            return f"{part(n, j)} * ({part(v, j)} + {gap(j)} * {gap(j)})"

        def product(j: int) -> str:
            return f"{part(n, j)} * ({part(c, j)} + {gap(j)} * _off{window}_{j})"

        enough = f"{k} >= {minimum_count(window)}"
        final[f"{name}_mean_w{window}"] = F.expr(f"CASE WHEN {enough} THEN {centre} END")
        final[f"{name}_std_w{window}"] = F.expr(
            f"CASE WHEN {enough} AND {k} > 1 THEN sqrt({total(square, js)} / ({k} - 1)) END"
        )
        final[f"{name}_slope_w{window}"] = F.expr(
            f"CASE WHEN {enough} AND {k} = _length{window} "
            f"THEN {total(product, js)} / _spread{window} END"
        )
    places = _places(windows, base)
    return _Stages(
        first, {**shifted, **places}, {**middle, **final},
        [n, m, v, c, *shifted, *places, *middle],
    )


def _derived(
    value: str, name: str, windows: Sequence[int], lags: Sequence[int], parts: Sequence[str]
) -> _Stages:
    base = _base_window(windows)
    if base is None:
        return _direct(value, name, windows, lags, parts)
    return _assembled(value, name, windows, lags, parts, base)


def _apply(df: DataFrame, stages: list[_Stages]) -> DataFrame:
    """All sensors advance together, so each stage is one operator."""
    def merged(field: str) -> dict[str, Column]:
        return {k: c for stage in stages for k, c in getattr(stage, field).items()}

    out = df.withColumns(merged("base"))
    if merged("shifted"):
        out = out.withColumns(merged("shifted"))
    final = merged("final")
    middle = {k: c for k, c in final.items() if k.startswith("_")}
    if middle:
        out = out.withColumns(middle)
    rest = {k: c for k, c in final.items() if not k.startswith("_")}
    if rest:
        out = out.withColumns(rest)
    return out.drop(*[h for stage in stages for h in stage.helpers])


def derived_names(sensor: str, windows: Sequence[int], lags: Sequence[int]) -> list[str]:
    """Feature columns of one sensor, in order."""
    rolled = [f"{sensor}_{kind}_w{w}" for w in windows for kind in ("mean", "std", "slope")]
    return rolled + [f"{sensor}_lag{k}" for k in lags]


def _reach(windows: Sequence[int], lags: Sequence[int]) -> int:
    return max([w - 1 for w in windows] + list(lags) + [0])


def add_features(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    windows: Sequence[int] = WINDOWS,
    lags: Sequence[int] = LAGS,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Add `{s}_mean_w{w}`, `{s}_std_w{w}`, `{s}_slope_w{w}` and `{s}_lag{k}` columns.

    All derived columns share one window over one exchange. Several windows that fit into each other
    are computed on batches of the ordered rows (`rolling`).
    """
    sensors = sensor_columns(df.columns) if sensors is None else list(sensors)
    framed, parts, finish = blocks(df, KEYS, CYCLE, _reach(windows, lags), rows, hot, dense)
    base = _base_window(windows)
    if base is None or not sensors:
        out = finish(_apply(framed, [_derived(s, s, windows, lags, parts) for s in sensors]))
    else:
        least = [minimum_count(w) for w in windows]
        out = finish(add_assembled(framed, sensors, windows, lags, parts, base, least))
    names = [n for s in sensors for n in derived_names(s, windows, lags)]
    return out.select(*df.columns, *names)


def long_features(
    df: DataFrame,
    sensors: Sequence[str] | None = None,
    windows: Sequence[int] = WINDOWS,
    lags: Sequence[int] = LAGS,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
    dense: bool = False,
) -> DataFrame:
    """The same features with one row per (reading, sensor): `mean_w10`, ..., `lag1`, ...

    With many sensors the window then evaluates a dozen expressions instead of hundreds.
    """
    sensors = sensor_columns(df.columns) if sensors is None else list(sensors)
    framed, _, finish = blocks(df, KEYS, CYCLE, _reach(windows, lags), rows, hot, dense)
    ids = [c for c in framed.columns if c not in sensors]
    block = [c for c in ("_block",) if c in ids]
    tall = framed.unpivot(ids, list(sensors), "sensor", "value")
    parts = [*KEYS, *block, "sensor"]
    out = finish(_apply(tall, [_derived("value", "value", windows, lags, parts)]))
    names = derived_names("value", windows, lags)
    kept = [c for c in df.columns if c not in sensors]
    return out.select(
        *kept, "sensor", "value", *[F.col(n).alias(n.removeprefix("value_")) for n in names]
    )


def add_sequences(
    df: DataFrame,
    features: Sequence[str],
    window: int = SEQUENCE_WINDOW,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
    dense: bool = False,
) -> DataFrame:
    """Every full window of `window` rows as `sequence array<array<float>>`, keyed by its last row."""
    framed, parts, finish = blocks(df, KEYS, CYCLE, window - 1, rows, hot, dense)
    step = F.array(*[F.coalesce(F.col(c), F.lit(0.0)).cast("float") for c in features])
    out = framed.withColumn("_step", step).withColumn(
        "sequence", F.collect_list("_step").over(trailing(parts, window))
    )
    return finish(out).drop("_step").where(F.size("sequence") == window)


def last_rows(df: DataFrame) -> DataFrame:
    """The latest reading of every unit; reduced map-side.

    One `max_by` per column keeps numeric buffers in the hash aggregate; a struct would sort.
    """
    rest = [c for c in df.columns if c not in KEYS]
    latest = df.groupBy(*KEYS).agg(*[F.max_by(c, CYCLE).alias(c) for c in rest])
    return latest.select(*df.columns)


class RollingLagTransformer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`add_features` as a pipeline stage."""

    sensors = Param(
        Params._dummy(), "sensors", "sensor columns; all when empty", TypeConverters.toListString
    )
    windowSizes = Param(
        Params._dummy(), "windowSizes", "rolling window lengths", TypeConverters.toListInt
    )
    lagSteps = Param(Params._dummy(), "lagSteps", "lags in rows", TypeConverters.toListInt)
    dense = Param(
        Params._dummy(), "dense", "cycles count 1, 2, ... in every unit", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(self, *, sensors=None, windowSizes=None, lagSteps=None, dense=None):
        super().__init__()
        self._setDefault(sensors=[], windowSizes=WINDOWS, lagSteps=LAGS, dense=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_features(
            dataset,
            self.getOrDefault("sensors") or None,
            self.getOrDefault("windowSizes"),
            self.getOrDefault("lagSteps"),
            dense=self.getOrDefault("dense"),
        )
