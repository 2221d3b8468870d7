"""Ordered computations whose work does not depend on how rows spread over groups.

A Spark window puts a whole group into one task. The helpers here cut each group, along its
order, into slices of bounded size, combine one row per slice to get offsets, and run the
window inside the slices. Slice numbers come from exact counts and bounds, so a recomputed
task lands in the same slice. Group keys must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fleetgauge.session import pinned

# Rows one task may hold for one group before the group is cut.
GROUP_ROWS = 250_000

_CELLS_PER_OCTAVE = 64
_OFFSET = 200_000  # larger than 64 cells for each of the 2,100 octaves of a double


def oversized(df: DataFrame, keys: Sequence[str], rows: int = GROUP_ROWS) -> bool:
    """Does any group hold more than `rows` rows? One pre-aggregated count over the key columns."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.where(F.col("_n") > rows).isEmpty()


def _axis(df: DataFrame, name: str) -> Column | None:
    """The column as a double that never decreases when the column increases."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        minutes = F.unix_date(F.to_date(col)).cast("bigint") * 1440 + F.hour(col) * 60 + F.minute(col)
        return minutes.cast("double") * 60.0 + F.extract(F.lit("SECOND"), col).cast("double")
    return None


def _log_cell(value: Column) -> Column:
    """Order-preserving cell on a logarithmic scale."""
    def cell(positive: Column) -> Column:
        octave = F.least(F.log2(positive), F.lit(1024.0))
        return F.floor(octave * _CELLS_PER_OCTAVE) + _OFFSET

    return (
        F.when(value.isNull(), F.lit(-2 * _OFFSET))
        .when(value > 0, cell(value))
        .when(value < 0, -cell(-value))
        .otherwise(F.lit(0))
    ).cast("bigint")


def _spread(df: DataFrame, keys: Sequence[str], name: str, agree: Sequence[str] = ()) -> DataFrame:
    """One row per slice: size and bounds along `name`, and whether all rows of the slice have
    equal values in the columns `agree`; only then may `name` split them."""
    axis = _axis(df, name)
    even = [(F.min(e) == F.max(e)) & (F.count(e) == F.count(F.lit(1))) for e in agree]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_cut_n"),
        F.min(axis).alias("_cut_lo"),
        F.max(axis).alias("_cut_hi"),
        F.coalesce(reduce(and_, even, F.lit(True)), F.lit(False)).alias("_cut_even"),
    )


def _too_large(rows: int) -> Column:
    return F.col("_cut_even") & (F.col("_cut_n") > rows) & (F.col("_cut_hi") > F.col("_cut_lo"))


def _split(
    df: DataFrame, spread: DataFrame, keys: Sequence[str], name: str, cell: str, rows: int
) -> DataFrame:
    """Cut slices above `rows` into equal widths along `name`."""
    axis = _axis(df, name)
    share = (axis - F.col("_cut_lo")) / (F.col("_cut_hi") - F.col("_cut_lo"))
    parts = F.ceil(F.col("_cut_n") / F.lit(rows))
    place = F.greatest(F.floor(share * parts), (axis >= F.col("_cut_hi")).cast("bigint"))  # the ends part for certain
    part = F.when(_too_large(rows) & axis.isNotNull(), place).otherwise(F.lit(0))
    return (
        df.join(spread, list(keys))
        .withColumn(cell, part.cast("bigint"))
        .drop("_cut_n", "_cut_lo", "_cut_hi", "_cut_even")
    )


def _first_cell(df: DataFrame, order: str) -> DataFrame:
    axis = _axis(df, order)
    if axis is None:
        raise ValueError(f"cannot cut along {order!r}: not a number, date or timestamp")
    return df.withColumn("_cell0", _log_cell(axis))


def cut(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], rows: int = GROUP_ROWS
) -> tuple[DataFrame, list[str]]:
    """Cut every group into slices along `order` until none exceeds `rows`, save rows that agree in
    all order columns.

    Returns the frame with cell columns; slices sort by those columns as their rows sort by
    `order`. Each round measures the slices (one row each, written to the shared folder) and
    splits those above `rows` by width; a round that isn't enough, as on values that crowd at one
    end, is followed by another inside the slices it left. The next column takes over where all
    earlier ones agree. A slice that can't be cut raises.
    """
    df = _first_cell(df, order[0])
    cells = ["_cell0"]
    for i, name in enumerate(order):
        while True:
            keys = [*groups, *cells]
            if _axis(df, name) is None:
                agree = [F.min(e) != F.max(e) for e in order[i:]]
                large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), reduce(or_, agree).alias("_mixed"))
                if not large.where((F.col("_n") > rows) & F.col("_mixed")).isEmpty():
                    raise ValueError(f"a slice of more than {rows} rows can't be cut along {name!r}")
                return df, cells
            spread = pinned(_spread(df, keys, name, order[:i]))
            if spread.where(F.col("_cut_n") > rows).isEmpty():
                return df, cells
            if spread.where(_too_large(rows)).isEmpty():
                break
            cell = f"_cell{len(cells)}"
            df = _split(df, spread, keys, name, cell, rows)
            cells.append(cell)
    return df, cells


def numbered(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    name: str,
    hot: bool | None = None,
    rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add the 1-based position of each row in its group.

    `hot` says whether a group may exceed `rows`; None measures it.
    """
    if hot is None:
        hot = oversized(df, groups, rows)
    if not hot:
        w = Window.partitionBy(*groups).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    sliced, cells = cut(df, groups, order, rows)
    keys = [*groups, *cells]
    before = Window.partitionBy(*groups).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pinned(
        sliced.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_slice_n"))
        .select(*keys, F.coalesce(F.sum("_slice_n").over(before), F.lit(0)).alias("_slice_before"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.join(offsets, keys)
        .withColumn(name, (F.col("_slice_before") + F.row_number().over(inside)).cast("bigint"))
        .drop("_slice_before", *cells)
    )


def running(
    histogram: DataFrame,
    groups: Sequence[str],
    order: str,
    sums: dict[str, str],
    totals: dict[str, str] | None = None,
    following: str | None = None,
    rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add running totals along `order`, one row per (group, order value) expected.

    `sums` maps each new column to the summed one; `totals` maps new columns to a running
    column whose value for the whole group they receive. `following` names a column that
    receives the next order value of the group.
    """
    totals = totals or {}
    sliced, cells = cut(pinned(histogram), groups, [order], rows)
    keys = [*groups, *cells]
    by_slice = Window.partitionBy(*groups).orderBy(*cells)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*keys)
        .agg(
            F.min(order).alias("_first"),
            *[F.sum(source).alias(f"_total_{new}") for new, source in sums.items()],
        )
        .select(
            *keys,
            F.lead("_first").over(by_slice).alias("_slice_next"),
            *[
                F.coalesce(F.sum(f"_total_{new}").over(before), F.lit(0)).alias(f"_off_{new}")
                for new in sums
            ],
            *[
                F.sum(f"_total_{of}").over(Window.partitionBy(*groups)).alias(new)
                for new, of in totals.items()
            ],
        )
    )
    inside = Window.partitionBy(*keys).orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = sliced.join(offsets, keys)
    added = {
        new: F.col(f"_off_{new}") + F.sum(source).over(upto) for new, source in sums.items()
    }
    if following:
        added[following] = F.coalesce(F.lead(order).over(inside), F.col("_slice_next"))
    return out.withColumns(added).drop(
        "_slice_next", *[f"_off_{new}" for new in sums], *cells
    )


def histogram(df: DataFrame, groups: Sequence[str], value: str, **sums: Column) -> DataFrame:
    """One row per distinct value of each group with a count `n` and further sums.

    Equal values meet in the map-side aggregate, so a value held by many rows costs nothing.
    """
    extra = [F.sum(c).alias(n) for n, c in sums.items()]
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )


def quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    levels: dict[str, float | Callable[[Column], Column]],
    rows: int = GROUP_ROWS,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    A level may be a function of the group's row count. Without groups there is one row.
    """
    base = df.select(*groups, F.col(value).cast("double").alias("_v"))
    return weighted_quantiles(histogram(base, groups, "_v"), groups, "_v", levels, rows)


def weighted_quantiles(
    hist: DataFrame,
    groups: Sequence[str],
    value: str,
    levels: dict[str, float | Callable[[Column], Column]],
    rows: int = GROUP_ROWS,
) -> DataFrame:
    """`quantiles` of a histogram with counts in `n`; also returns the count as `n`."""
    ranked = running(hist, groups, value, {"_upto": "n"}, {"_size": "_upto"}, rows=rows)
    picks, outs = [], []
    for name, level in levels.items():
        share = level(F.col("_size")) if callable(level) else F.lit(float(level))
        h = share * (F.col("_size") - 1)
        for tag, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            here = (F.col("_upto") - F.col("n") <= at) & (at < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{tag}_{name}"))
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        share_out = level(F.col("n")) if callable(level) else F.lit(float(level))
        h_out = share_out * (F.col("n") - 1)
        outs.append((low + (high - low) * (h_out - F.floor(h_out))).alias(name))
    return (
        ranked.groupBy(*groups)
        .agg(F.max("_size").alias("n"), *picks)
        .select(*groups, "n", *outs)
    )


def blocks(
    df: DataFrame, keys: Sequence[str], order: str, reach: int, rows: int = GROUP_ROWS,
    hot: bool | None = None, dense: bool = False,
) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """Prepare trailing row frames that look back at most `reach` rows.

    Returns the frame with a row position `_pos`, the columns to partition a window by, and a
    function to apply afterwards. Groups above `rows` are cut by position into blocks, each of
    which also receives the last `reach` rows before it, so every frame is complete in its block.
    `dense` says that `order` itself counts 1, 2, ... in every group.
    """
    if hot is None:
        hot = oversized(df, keys, rows)
    if dense:
        placed = df.withColumn("_pos", F.col(order).cast("bigint"))
    else:
        placed = numbered(df, keys, [order], "_pos", hot=hot, rows=rows)
    if not hot:
        return placed, list(keys), lambda out: out.drop("_pos")
    if reach >= rows:
        raise ValueError("reach must be smaller than the block size")
    own = F.floor((F.col("_pos") - 1) / rows).cast("bigint")
    near_end = F.pmod(F.col("_pos") - 1, F.lit(rows)) >= rows - reach
    spread = (
        placed.withColumn("_own", own)
        .withColumn("_block", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    )
    return spread, [*keys, "_block"], lambda out: out.where("_block = _own").drop(
        "_block", "_own", "_pos"
    )
