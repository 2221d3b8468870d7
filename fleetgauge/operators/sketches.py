"""Stored sketches: quantiles and distinct counts of any span of days without reading rows again.

A day's rows are reduced once to a KLL and an HLL sketch per group; the sketches are binary columns
of a table that grows by appends. Merging sketches answers as sketching all rows at once would, up to
the sketches' own error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

#: KLL size (normalised rank error about 1.3 % at 200) and log2 of HLL registers (1.6 % at 12).
KLL_SIZE = 200
HLL_LOG = 12


def sketched(
    df: DataFrame, groups: Sequence[str], value: str, member: str, size: int = KLL_SIZE, log: int = HLL_LOG
) -> DataFrame:
    """Per group: `n_rows`, `values` (KLL of `value`) and `members` (HLL of `member`); partial sketches
    are merged map-side. Missing values are in `n_rows` only."""
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("values"),
        F.hll_sketch_agg(member, log).alias("members"),
    )


def append_sketches(sketches: DataFrame, path: str, partition: str) -> None:
    sketches.write.mode("append").partitionBy(partition).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups, from the stored ones alone."""
    return sketches.groupBy(*groups).agg(
        F.sum("n_rows").alias("n_rows"),
        F.kll_merge_agg_double("values").alias("values"),
        F.hll_union_agg("members").alias("members"),
    )


def answers(sketches: DataFrame, levels: dict[str, float]) -> DataFrame:
    """The sketches' quantiles at `levels` and `n_members`, the estimated distinct count."""
    some = F.kll_sketch_get_n_double("values") > 0
    found = {n: F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(q))) for n, q in levels.items()}
    out = sketches.withColumns({**found, "n_members": F.hll_sketch_estimate("members")})
    return out.drop("values", "members")


def rank_errors(found: DataFrame, df: DataFrame, groups: Sequence[str], value: str, levels: dict[str, float]) -> DataFrame:
    """Per group the largest distance between a level and the ranks its answer has among the rows:
    one pass over the rows beside the few answers."""
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull()).join(found.select(*groups, *levels), list(groups))
    shares = {f"{n}_{side}": F.avg(c.cast("double")) for n in levels for side, c in (("below", x < F.col(n)), ("upto", x <= F.col(n)))}
    ranks = rows.groupBy(*groups).agg(*[c.alias(n) for n, c in shares.items()])
    errors = [F.greatest(F.col(f"{n}_below") - q, q - F.col(f"{n}_upto"), F.lit(0.0)) for n, q in levels.items()]
    return ranks.select(*groups, (F.greatest(*errors) if len(errors) > 1 else errors[0]).alias("rank_error"))
