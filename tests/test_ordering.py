"""Sliced computations equal the plain window, whatever the slice size and the skew."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from fleetgauge.functions import ordering

from fleetgauge.functions.ordering import (
    blocks, cut, histogram, numbered, oversized, quantiles, running,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; values are negative, repeated, tiny and huge."""
    rng = np.random.default_rng(1)
    rows = [("hot", float(v), i) for i, v in enumerate(rng.integers(-300, 300, 900))]
    rows += [("hot", float(v), 2000 + i) for i, v in enumerate(rng.lognormal(0, 8, 200))]
    rows += [("cold", 1.0, 5000 + i) for i in range(20)]
    rows += [("one", 3.5, 9000)]
    return spark.createDataFrame(rows, "g string, v double, id int").cache()


@pytest.mark.parametrize("rows", [3, 50, 100_000])
def test_numbered_equals_row_number(skewed, rows):
    w = Window.partitionBy("g").orderBy("v", "id")
    expected = skewed.withColumn("p", F.row_number().over(w).cast("bigint"))
    found = numbered(skewed, ["g"], ["v", "id"], "p", hot=True, rows=rows)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("rows", [2, 40, 100_000])
def test_running_equals_window(skewed, rows):
    hist = histogram(skewed, ["g"], "v", s=F.col("id").cast("bigint"))
    w = Window.partitionBy("g").orderBy("v")
    expected = hist.select(
        "g", "v", F.sum("n").over(w).alias("c"), F.sum("s").over(w).alias("cs"),
        F.sum("n").over(Window.partitionBy("g")).alias("t"), F.lead("v").over(w).alias("nx"),
    )
    found = running(hist, ["g"], "v", {"c": "n", "cs": "s"}, {"t": "c"}, following="nx", rows=rows)
    found = found.select("g", "v", "c", "cs", "t", "nx")
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)


def test_slices_are_bounded_and_ordered(skewed):
    sliced, cells = cut(skewed, ["g"], ["v", "id"], rows=40)
    sizes = [r["count"] for r in sliced.groupBy("g", *cells).count().collect()]
    assert max(sizes) <= 200  # uneven values inside a slice may exceed the target, not by much
    w = Window.partitionBy("g").orderBy(*cells, "v", "id")
    plain = Window.partitionBy("g").orderBy("v", "id")
    moved = sliced.withColumn("a", F.row_number().over(w)).withColumn("b", F.row_number().over(plain))
    assert moved.where("a <> b").count() == 0


def test_ties_are_split_by_later_columns(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.lit(5).alias("day"), F.col("id"))
    sliced, cells = cut(df, ["g"], ["day", "id"], rows=50)
    assert max(r["count"] for r in sliced.groupBy(*cells).count().collect()) <= 60


@pytest.mark.parametrize("rows", [3, 100_000])
def test_quantiles_equal_numpy(skewed, rows):
    levels = {"a": 0.0, "b": 0.13, "c": 0.5, "d": 0.99, "e": 1.0}
    found = {r["g"]: r for r in quantiles(skewed, ["g"], "v", levels, rows=rows).collect()}
    for g in ("hot", "cold", "one"):
        values = np.array([r["v"] for r in skewed.where(F.col("g") == g).collect()])
        for name, level in levels.items():
            assert found[g][name] == pytest.approx(np.quantile(values, level), rel=1e-12)


def test_quantile_without_groups_and_without_rows(skewed):
    row = quantiles(skewed, [], "v", {"m": 0.5}).first()
    values = [r["v"] for r in skewed.collect()]
    assert row["m"] == pytest.approx(np.median(values)) and row["n"] == len(values)
    empty = quantiles(skewed.where("false"), [], "v", {"m": 0.5}).first()
    assert empty["m"] is None


def test_oversized(skewed):
    assert oversized(skewed, ["g"], 100) and not oversized(skewed, ["g"], 5000)


def test_blocks_give_complete_frames(readings):
    df = readings({1: 57, 2: 3})
    framed, parts, finish = blocks(df, ["variant", "unit_id"], "cycle", reach=4, rows=10, hot=True)
    w = Window.partitionBy(*parts).orderBy("cycle").rowsBetween(-4, 0)
    out = finish(framed.withColumn("s", F.sum("sensor_1").over(w)))
    plain = Window.partitionBy("unit_id").orderBy("cycle").rowsBetween(-4, 0)
    expected = df.withColumn("s", F.sum("sensor_1").over(plain))
    pick = lambda d: sorted(tuple(r) for r in d.select("unit_id", "cycle", "s").collect())
    assert pick(out) == pick(expected)
    assert framed.groupBy(*parts).count().agg(F.max("count")).first()[0] <= 14


def test_partitioning_does_not_change_results(skewed):
    def values(df):
        out = quantiles(df, ["g"], "v", {"m": 0.37}, rows=20)
        return sorted((r["g"], r["m"]) for r in out.collect())

    assert values(skewed.repartition(1)) == values(skewed.repartition(17))


@pytest.mark.parametrize("shape", ["saturated", "tail"])
def test_slices_keep_their_bound_on_skewed_values(spark, shape):
    values = spark.range(20_000).withColumn("u", (F.col("id") + 1) / 1000.0)
    v = 1 - F.exp(-F.col("u") / 1.2) if shape == "saturated" else F.exp(F.col("u") * 20)
    df = values.select(F.lit("a").alias("g"), v.alias("v")).distinct()
    sliced, cells = ordering.cut(df, ["g"], ["v"], 500)
    sizes = sliced.groupBy(*cells).agg(F.count("*").alias("n"), (F.min("v") == F.max("v")).alias("even"))
    assert sizes.where("n > 500 AND NOT even").isEmpty()
    hist = df.withColumn("n", F.lit(1))
    found = ordering.running(hist, ["g"], "v", {"upto": "n"}, rows=500)
    ranks = found.select("upto", F.row_number().over(Window.partitionBy("g").orderBy("v")).alias("rank"))
    assert ranks.where("upto <> rank").isEmpty()


def test_a_slice_that_cannot_be_cut_raises(spark):
    df = spark.range(100).select(F.lit("a").alias("g"), F.lit(1).alias("k"), F.col("id").cast("string").alias("s"))
    with pytest.raises(ValueError):
        ordering.cut(df, ["g"], ["k", "s"], 10)
