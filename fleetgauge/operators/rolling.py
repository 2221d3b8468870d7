"""Rolling and lagged features of many sensors at once, on batches of rows dealt out by unit.

A window function over hundreds of expressions evaluates each of them row by row; here Spark deals out and
orders the rows, and every feature of a batch is a few array operations. A batch also gets the last rows of
the batch before it, as far as frames look back, so units may go on from one batch to the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fleetgauge.schema import CYCLE


def _frames(values: np.ndarray, window: int) -> np.ndarray:
    """One row per value: the last `window` values up to it, oldest first."""
    return sliding_window_view(np.concatenate([np.zeros(window - 1, values.dtype), values]), window)


def _moments(x: np.ndarray, seen: np.ndarray, place: np.ndarray, pos: np.ndarray, base: int) -> list[np.ndarray]:
    """Count, mean, variance and covariance with the position over the last `base` rows of the unit."""
    inside = _frames(seen, base) & (place[:, None] > np.arange(base - 1, -1, -1))
    n = inside.sum(axis=1).astype(float)
    some = np.maximum(n, 1.0)

    def total(values: np.ndarray) -> np.ndarray:
        return np.where(inside, values, 0.0).sum(axis=1)

    values, positions = _frames(x, base), _frames(pos, base)
    newest = base - 1 - inside[:, ::-1].argmax(axis=1)
    apart = values - np.take_along_axis(values, newest[:, None], axis=1)  # exactly 0 in a frame of equal values
    apart = apart - (total(apart) / some)[:, None]
    ahead = positions - (total(positions) / some)[:, None]
    return [n, total(values) / some, total(apart * apart) / some, total(apart * ahead) / some]


def _earlier(values: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
    """The value `rows` rows earlier in the unit, 0 before its first."""
    if not rows:
        return values
    moved = np.concatenate([np.zeros(min(rows, len(values))), values[:-rows]])
    return np.where(place > rows, moved, 0.0)


def _rolled(moments: list[np.ndarray], place: np.ndarray, pos: np.ndarray, window: int, base: int, least: int) -> list[pa.Array]:
    """Mean, deviation and slope over `window` rows from the moments of its parts of `base` rows."""
    parts = [[_earlier(m, place, j * base) for m in moments] for j in range(window // base)]
    count = sum(p[0] for p in parts)
    some = np.maximum(count, 1.0)
    centre = parts[0][1] if len(parts) == 1 else sum(p[0] * p[1] for p in parts) / some
    length = np.minimum(float(window), pos)
    squares, products = np.zeros(len(pos)), np.zeros(len(pos))
    for j, (n, mean, variance, product) in enumerate(parts):
        gap = 0.0 if len(parts) == 1 else mean - centre
        held = np.maximum(0.0, np.minimum(float(base), pos - j * base))
        off = (length - 1) / 2 - j * base - (held - 1) / 2
        squares = squares + n * (variance + gap * gap)
        products = products + n * (product + gap * off)
    spread = length * (length * length - 1) / 12
    enough = count >= least
    whole = enough & (count == length) & (spread != 0)
    return [
        pa.array(centre, mask=~enough),
        pa.array(np.sqrt(squares / np.maximum(count - 1, 1.0)), mask=~(enough & (count > 1))),
        pa.array(products / np.where(whole, spread, 1.0), mask=~whole),
    ]


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    seen = column.is_valid().to_numpy(zero_copy_only=False)
    return column.fill_null(0.0).to_numpy(zero_copy_only=False), seen


def add_assembled(
    df: DataFrame, sensors: Sequence[str], windows: Sequence[int], lags: Sequence[int], parts: Sequence[str],
    base: int, least: Sequence[int],
) -> DataFrame:
    """`df` (with `_pos`, the row's position in its unit) and per sensor `{s}_mean_w{w}`, `{s}_std_w{w}`,
    `{s}_slope_w{w}` and `{s}_lag{k}`. Windows are multiples of `base` and need `least` values each."""
    order = Window.partitionBy(*parts).orderBy(CYCLE)
    doubles = {s: f"_x{i}" for i, s in enumerate(sensors)}
    placed = df.withColumn("_place", F.row_number().over(order)).withColumns(
        {x: F.col(s).cast("double") for s, x in doubles.items()}
    )
    ordered = placed.sortWithinPartitions(*parts, CYCLE)  # as the window left them: no further sort
    kept, held = df.columns, max([*windows, *lags])
    added = []
    for s in sensors:
        added += [T.StructField(f"{s}_{kind}_w{w}", T.DoubleType()) for w in windows for kind in ("mean", "std", "slope")]
        added += [T.StructField(f"{s}_lag{k}", df.schema[s].dataType) for k in lags]
    names = [*kept, *(f.name for f in added)]
    read = list(dict.fromkeys([*sensors, *doubles.values(), "_pos", "_place"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch.select(read)])
            whole = table if before is None else pa.concat_tables([before, table])
            whole = whole.combine_chunks()
            before = whole.slice(max(0, whole.num_rows - held))
            start = whole.num_rows - batch.num_rows
            column = {n: whole[n].combine_chunks() for n in read}
            place, pos = column["_place"].to_numpy(), column["_pos"].to_numpy().astype(float)
            own = np.arange(start, whole.num_rows)
            out = list(batch.select(kept).columns)
            with np.errstate(invalid="ignore", over="ignore"):
                for s, x in doubles.items():
                    moments = _moments(*_numbers(column[x]), place, pos, base)
                    for window, enough in zip(windows, least):
                        out += [a.slice(start) for a in _rolled(moments, place, pos, window, base, enough)]
                    for k in lags:
                        at = pa.array(np.maximum(own - k, 0), mask=place[start:] <= k)
                        out.append(column[s].take(at))
            yield pa.RecordBatch.from_arrays(out, names=names)

    return ordered.mapInArrow(run, T.StructType([*df.schema.fields, *added]))
