"""Validation of reading tables as predicates, with violations as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetgauge.schema import CYCLE, KEYS, OPS, SENSORS
from fleetgauge.session import pinned


@dataclass(frozen=True)
class Range:
    """Allowed values of one column; NULL counts as a violation when `required`."""

    column: str
    low: float | None = None
    high: float | None = None
    above_low: bool = False  # the lower bound itself is not allowed
    required: bool = True

    def broken(self) -> Column:
        x = F.col(self.column)
        bad = F.lit(False)
        if self.low is not None:
            bad = bad | ((x <= self.low) if self.above_low else (x < self.low))
        if self.high is not None:
            bad = bad | (x > self.high)
        return F.when(x.isNull(), F.lit(self.required)).otherwise(bad)


# Ranges of the load check and of the stricter serving check.
LOAD_RULES = [
    Range("unit_id", 0, above_low=True),
    Range("cycle", 0, above_low=True),
    Range("op_setting_1", -1.0, 1.0),
    Range("op_setting_2", -1.0, 1.0),
    Range("op_setting_3", 0.0, 100.0),
    *[Range(s) for s in SENSORS],
]
SERVING_RANGES = {
    "sensor_2": (500.0, 700.0),
    "sensor_3": (1200.0, 1700.0),
    "sensor_4": (1000.0, 1700.0),
    "sensor_7": (500.0, 600.0),
    "sensor_8": (2300.0, 2500.0),
    "sensor_9": (7000.0, 10000.0),
    "sensor_11": (38.0, 60.0),
    "sensor_12": (500.0, 560.0),
    "sensor_13": (2300.0, 2500.0),
    "sensor_14": (7000.0, 10000.0),
    "sensor_19": (80.0, 110.0),
    "sensor_20": (20.0, 50.0),
}
SERVING_RULES = [
    Range("unit_id", 1),
    Range("cycle", 1),
    Range("op_setting_1", -1.0, 1.0),
    Range("op_setting_2", -1.0, 1.0),
    Range("op_setting_3", 0.0, 100.0),
    *[Range(s, *SERVING_RANGES.get(s, (None, None))) for s in SENSORS],
]


class ValidationError(ValueError):
    """Raised in fail mode with the violation counts."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns that are absent, sorted; a schema check without a job."""
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    absent = missing_columns(df, required)
    if absent:
        raise ValidationError(f"missing required columns: {absent}")


def rules_for(df: DataFrame, rules: Sequence[Range] = LOAD_RULES) -> list[Range]:
    """The rules of the columns that a frame has: for views that hold a part of a reading by intent."""
    return [r for r in rules if r.column in df.columns]


def _broken(df: DataFrame, rule: Range) -> Column:
    """A required column that the frame lacks is broken in every row; an optional one in none."""
    return rule.broken() if rule.column in df.columns else F.lit(rule.required)


def _broken_list(df: DataFrame, rules: Sequence[Range]) -> Column:
    entries = [
        F.when(
            _broken(df, r),
            F.struct(
                F.lit(r.column).alias("column"),
                (F.col(r.column).cast("double") if r.column in df.columns else F.lit(None).cast("double")).alias("value"),
            ),
        )
        for r in rules
    ]
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def violations(df: DataFrame, rules: Sequence[Range] = LOAD_RULES) -> DataFrame:
    """One row per broken rule: keys, `column`, `value`. One pass, no shuffle."""
    keys = [c for c in (*KEYS, CYCLE) if c in df.columns]
    return df.select(*keys, F.inline(_broken_list(df, rules)))


def mark_valid(df: DataFrame, rules: Sequence[Range] = LOAD_RULES) -> DataFrame:
    """`is_valid`: no rule of the row itself is broken; one pass, also on a stream. Repeated keys are
    marked by `mark_all`."""
    ok = reduce(and_, [~_broken(df, r) for r in rules], F.lit(True))
    return df.withColumn("is_valid", ok)


def _empty(df: DataFrame) -> Column:
    values = [F.col(c).cast("string") for c in df.columns if c != "variant"]
    return F.coalesce(*values).isNull() if values else F.lit(True)


def mark_all(df: DataFrame, rules: Sequence[Range] = LOAD_RULES) -> DataFrame:
    """`broken`: all violations of each row: columns out of range or absent, `unique` on every row but
    the first of a repeated key, `all_missing` on empty rows. One shuffle by key; of a repeated key's
    rows the first by all columns counts as the original, and keys of many rows are told by counts per
    distinct row, not by a window over them."""
    keys = [c for c in (*KEYS, CYCLE) if c in df.columns]
    digest = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    rows = df.withColumn("_digest", digest).withColumn("_turn", F.monotonically_increasing_id())
    rows = pinned(rows)  # the turn must not change when a task is run again
    first = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(F.struct("_digest", "_turn")).alias("_first"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.lit(True))
    joined = rows.join(first, same)
    names = F.transform(_broken_list(df, rules), lambda e: e["column"])
    extra = F.array(
        F.when(F.struct("_digest", "_turn") != F.col("_first"), F.lit("unique")),
        F.when(_empty(df), F.lit("all_missing")),
    )
    broken = F.concat(names, F.filter(extra, lambda e: e.isNotNull()))
    return joined.select(*df.columns, broken.alias("broken"))


def quarantine(
    df: DataFrame, rules: Sequence[Range] = LOAD_RULES
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the list of what they break (`mark_all`)."""
    marked = pinned(mark_all(df, rules))
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = (*KEYS, CYCLE)) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def all_missing_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull())


def coerce(df: DataFrame, types: dict[str, T.DataType | str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns; a value that was present but cannot be cast is a violation `(column, text)`."""
    cast = {c: F.col(c).try_cast(t) for c, t in types.items()}
    entries = [
        F.when(
            F.col(c).isNotNull() & cast[c].isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")),
        )
        for c in types
    ]
    failed = df.select(
        *[c for c in df.columns if c not in types],
        F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())),
    )
    return df.withColumns(cast), failed


def report(df: DataFrame, rules: Sequence[Range] = LOAD_RULES) -> DataFrame:
    """All violations counted by rule: `(rule, column, n)`."""
    by_range = (
        violations(df, rules)
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("range").alias("rule"), "column", "n")
    )
    keys = [c for c in (*KEYS, CYCLE) if c in df.columns]
    repeated = duplicate_keys(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    empty = all_missing_rows(df, [c for c in df.columns if c != "variant"]).agg(
        F.count(F.lit(1)).alias("n")
    )
    return by_range.unionByName(
        repeated.select(F.lit("unique").alias("rule"), F.lit("unit_id,cycle").alias("column"), "n")
    ).unionByName(
        empty.select(F.lit("all_missing").alias("rule"), F.lit("*").alias("column"), "n")
    ).where("n > 0")


def validate(
    df: DataFrame, rules: Sequence[Range] = LOAD_RULES, mode: str = "fail",
    required: Sequence[str] = (*KEYS[1:], CYCLE, *OPS, *SENSORS),
) -> DataFrame:
    """`fail` raises with all counted violations; `lenient` keeps every row with `is_valid` and what it
    breaks (`mark_all`)."""
    if mode == "lenient":
        return mark_all(df, rules).withColumn("is_valid", F.size("broken") == 0)
    if mode != "fail":
        raise ValueError("mode must be 'fail' or 'lenient'")
    require_columns(df, required)
    found = report(df, rules).collect()  # at most one row per rule
    if found:
        raise ValidationError("; ".join(f"{r['rule']} {r['column']}: {r['n']}" for r in found))
    return df
