"""Scalar column helpers that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# Modulus and multipliers of the key hash; products stay inside 64 bits.
PRIME = 2147483647
MIX_STEP = 69621
MIX_KEY = 48271
MIX_ADD = 1013904223
MIX_LAST = 630360016


def linspace(low: float, high: float, count: int) -> list[float]:
    """Evenly spaced doubles, not rounded."""
    return [float(v) for v in np.linspace(low, high, count)]


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values are NULL in the engine; NaN would sort above every number."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in columns})


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; missing stays missing."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull() & ~F.isnan(value), out)


def key_hash(seed: int, *keys: Column) -> Column:
    """Integer in [0, PRIME) from the seed and integer keys, the same wherever a row is computed."""
    state = F.lit(seed % PRIME).cast("bigint")
    for key in keys:
        part = F.pmod(key.cast("bigint"), F.lit(PRIME).cast("bigint"))
        state = (state * MIX_STEP + part * MIX_KEY + 11) % PRIME
    state = (state * state + MIX_ADD) % PRIME
    state = (state * MIX_LAST + 7) % PRIME
    return (state * state + state + 1) % PRIME


def key_uniform(seed: int, *keys: Column) -> Column:
    """Uniform number in [0, 1) from the keys."""
    return key_hash(seed, *keys) / F.lit(float(PRIME))


def text_key(text: Column) -> Column:
    """Integer key of a string, for use in `key_hash`."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("bigint")


def fixed0(value: Column) -> Column:
    """Whole number with ties to even, as text."""
    return F.bround(value, 0).cast("bigint").cast("string")
