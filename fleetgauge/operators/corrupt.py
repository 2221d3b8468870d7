"""Seeded sensor corruption for stress tests. Draws depend on keys only, never on layout."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetgauge.functions.ordering import GROUP_ROWS, numbered, oversized, running
from fleetgauge.functions.scalars import PRIME, key_uniform, text_key
from fleetgauge.operators.splits import zero_filled
from fleetgauge.schema import CYCLE, KEYS, SEED
from fleetgauge.session import pinned

# Deviation that counts as constant and the noise used then.
CONSTANT_STD = 1e-10
CONSTANT_NOISE = 0.01


def _columns(df: DataFrame, sensors: Sequence[str]) -> list[str]:
    return [c for c in sensors if c in df.columns]


def _draw(seed: int, column: str, stream: int) -> Column:
    number = sum(ord(ch) * 131**i for i, ch in enumerate(column)) % PRIME
    return key_uniform(
        seed, text_key(F.col("variant")), F.col("unit_id"), F.col(CYCLE), F.lit(number), F.lit(stream)
    )


def inject_missing(
    df: DataFrame, sensors: Sequence[str], rate: float = 0.1, seed: int = SEED
) -> DataFrame:
    """Drop each (row, sensor) value independently with probability `rate`."""
    return df.withColumns(
        {c: F.when(_draw(seed, c, 0) >= rate, F.col(c)) for c in _columns(df, sensors)}
    )


def noise_levels(df: DataFrame, sensors: Sequence[str], snr_db: float) -> dict[str, float]:
    """Noise deviation per sensor, one aggregate for all; sensors without values are left out."""
    cols = _columns(df, sensors)
    if not cols:
        return {}
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {
        c: CONSTANT_NOISE if row[c] < CONSTANT_STD else row[c] / 10.0 ** (snr_db / 20.0)
        for c in cols
        if row[c] is not None
    }


def inject_noise(
    df: DataFrame, sensors: Sequence[str], snr_db: float = 10.0, seed: int = SEED
) -> DataFrame:
    """Add normal noise at a signal-to-noise ratio; missing stays missing."""
    def normal(c: str) -> Column:
        u = F.greatest(_draw(seed, c, 1), F.lit(1.0 / PRIME))
        return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * _draw(seed, c, 2))

    return df.withColumns(
        {c: F.col(c) + F.lit(s) * normal(c) for c, s in noise_levels(df, sensors, snr_db).items()}
    )


def with_row_index(df: DataFrame, hot: bool | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """Add the 0-based `_row` of the table sorted by variant, unit and cycle.

    Unit sizes give each unit's first row; rows are then numbered inside their unit.
    """
    sizes = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"))
    units = running(sizes, ["variant"], "unit_id", {"_upto": "_n"})
    per_variant = sizes.groupBy("variant").agg(F.sum("_n").alias("_total"))
    before = Window.orderBy("variant").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_variant.select("variant", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    first = units.join(starts, "variant").select(
        *KEYS, (F.col("_start") + F.col("_upto") - F.col("_n")).alias("_first")
    )
    placed = numbered(df, KEYS, [CYCLE], "_at", hot=hot, rows=rows)
    return placed.join(first, KEYS).withColumn("_row", F.col("_first") + F.col("_at") - 1).drop(
        "_first", "_at"
    )


def inject_flatline(
    df: DataFrame, sensors: Sequence[str], fraction: float = 0.2, seed: int = SEED,
    hot: bool | None = None, rows: int = GROUP_ROWS,
) -> DataFrame:
    """Freeze one contiguous block of `max(1, int(n * fraction))` rows per sensor at the value
    of its first row; the block may start anywhere and may cross units."""
    cols = _columns(df, sensors)
    n = df.count()
    if not cols or n == 0:
        return df
    length = max(1, int(n * fraction))
    if hot is None:
        hot = oversized(df, KEYS, rows)
    indexed = with_row_index(df, hot, rows)
    starts = {}
    for i, c in enumerate(cols):
        mixed = (seed * 69621 + (i + 1) * 48271) % PRIME
        mixed = (mixed * mixed + 1013904223) % PRIME
        starts[c] = mixed % max(1, n - length + 1)
    wanted = indexed.where(F.col("_row").isin(*starts.values()))
    frozen = wanted.agg(
        *[F.max(F.when(F.col("_row") == starts[c], F.col(c))).alias(c) for c in cols]
    ).first()  # one value per sensor
    changed = {
        c: F.when(
            F.col("_row").between(starts[c], min(starts[c] + length, n) - 1), F.lit(frozen[c])
        ).otherwise(F.col(c))
        for c in cols
    }
    return indexed.withColumns(changed).drop("_row").select(*df.columns)


def stressed(
    df: DataFrame, sensors: Sequence[str], rate: float = 0.2, snr_db: float = 10.0, fraction: float = 0.2,
    seed: int = SEED, hot: bool | None = None, rows: int = GROUP_ROWS,
) -> DataFrame:
    """`df` four times, told apart by `corruption`: clean, missing, noise and flatline; missing sensor
    values are 0 in each, as the models read them. Only that many copies are ever made, so that one
    grouped job compares a model's metrics on all of them. `df` and the copies are written once: later
    plans, filters above all, would else repeat the draws; give only the columns that are needed."""
    df = pinned(df)
    kinds = {
        "clean": df,
        "missing": inject_missing(df, sensors, rate, seed),
        "noise": inject_noise(df, sensors, snr_db, seed),
        "flatline": inject_flatline(df, sensors, fraction, seed, hot, rows),
    }
    cols = _columns(df, sensors)
    tagged = [
        zero_filled(part, cols).withColumn("corruption", F.lit(kind)) for kind, part in kinds.items()
    ]
    return pinned(reduce(DataFrame.unionByName, tagged))
