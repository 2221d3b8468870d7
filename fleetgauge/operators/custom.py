"""User functions over the ordered readings of a unit, for what no built-in window expresses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

from fleetgauge.functions.ordering import GROUP_ROWS, blocks
from fleetgauge.operators.features import minimum_count
from fleetgauge.schema import CYCLE, KEYS, sensor_columns

_HELPERS = ("_pos", "_block", "_own")
_FRAMES = 8192  # frames handed to a user function at once


def add_from_function(
    df: DataFrame, function: Callable[[pa.Table], Mapping[str, object]], added: Mapping[str, T.DataType],
    reach: int = 0, hot: bool | None = None, rows: int = GROUP_ROWS, dense: bool = False,
) -> DataFrame:
    """Add the columns that `function` makes of a unit's readings, in cycle order.

    `function` gets an Arrow table and returns one array a column of `added`, as long as the table;
    NaN becomes NULL in them. A unit above `rows` is cut: each piece also holds the `reach` readings
    before it, whose results are dropped, so a result may depend on no reading further back. Rows dealt
    out by unit before are not moved again. Columns of `added` that exist are replaced."""
    df = df.drop(*added)
    framed, parts, finish = blocks(df, KEYS, CYCLE, reach, rows, hot, dense)
    kinds = {name: to_arrow_type(kind) for name, kind in added.items()}
    helpers = [c for c in _HELPERS if c in framed.columns]

    def run(piece: pa.Table) -> pa.Table:
        piece = piece.sort_by("_pos")
        made = function(piece.drop_columns(helpers))
        for name, kind in kinds.items():
            values = made[name]
            if len(values) != len(piece):
                raise ValueError(f"{name!r} has {len(values)} values for {len(piece)} readings")
            piece = piece.append_column(name, pa.array(values, kind, from_pandas=True))
        return piece

    schema = T.StructType([*framed.schema.fields, *(T.StructField(n, k) for n, k in added.items())])
    return finish(framed.groupBy(*parts).applyInArrow(run, schema)).select(*df.columns, *added)


def frames(values: np.ndarray, window: int) -> np.ndarray:
    """One row per value: the last `window` values up to it, with NaN before the first."""
    return sliding_window_view(np.concatenate([np.full(window - 1, np.nan), values]), window)


def add_rolling(
    df: DataFrame, functions: Mapping[str, Callable[[np.ndarray], np.ndarray]], window: int,
    sensors: Sequence[str] | None = None, hot: bool | None = None, rows: int = GROUP_ROWS, dense: bool = False,
) -> DataFrame:
    """Add `{sensor}_{name}_w{window}` for own rolling functions by name.

    A function turns an array (readings x window), NaN where a value is missing or before the first
    reading, into one number a reading. As in the built-in features a result is NULL where fewer than
    half a window of values is there; the function never sees such frames."""
    sensors = sensor_columns(df.columns) if sensors is None else list(sensors)
    least = minimum_count(window)

    def made(piece: pa.Table) -> dict[str, np.ndarray]:
        out = {}
        for sensor in sensors:
            values = piece[sensor].cast(pa.float64()).to_numpy()
            held = frames(values, window)
            for name, function in functions.items():
                result = np.full(len(values), np.nan)
                for start in range(0, len(values), _FRAMES):
                    some = held[start : start + _FRAMES]
                    enough = np.count_nonzero(~np.isnan(some), axis=1) >= least
                    if enough.any():
                        result[start : start + _FRAMES][enough] = function(some[enough])
                out[f"{sensor}_{name}_w{window}"] = result
        return out

    names = [f"{s}_{n}_w{window}" for s in sensors for n in functions]
    return add_from_function(df, made, dict.fromkeys(names, T.DoubleType()), window - 1, hot, rows, dense)
