"""User functions per unit: the same as built-in features, also where a unit is cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from fleetgauge.operators import custom
from fleetgauge.operators import features as feat


def noisy(unit, cycle, sensor):
    return None if (unit * 7 + cycle) % 5 == 0 else float((cycle * 37 + unit * 11) % 23)


@pytest.fixture(scope="module")
def fleet(readings):
    return readings({1: 70, 2: 41, 3: 4}, ("sensor_1",), noisy).cache()


def same(left, right):
    a, b = (x.orderBy("unit_id", "cycle").collect() for x in (left, right))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None) == (v is None) and (u == v or u == pytest.approx(v, abs=1e-9)), (x, y)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("dense", [False, True])
def test_own_mean_equals_the_built_in_one(fleet, hot, dense):
    shuffled = fleet.repartition(5, "cycle")
    own = custom.add_rolling(
        shuffled, {"mean": lambda held: np.nanmean(held, axis=1)}, 10, hot=hot, rows=33, dense=dense
    )
    built = feat.add_features(fleet, ["sensor_1"], [10], [], hot=hot, rows=33)
    names = ["unit_id", "cycle", "sensor_1", "sensor_1_mean_w10"]
    same(own.select(names), built.select(names))


@pytest.mark.parametrize("hot", [False, True])
def test_own_median_equals_pandas(fleet, hot):
    out = custom.add_rolling(fleet, {"median": lambda h: np.nanmedian(h, axis=1)}, 7, hot=hot, rows=20)
    got = out.toPandas().sort_values(["unit_id", "cycle"])
    for _, unit in got.groupby("unit_id"):
        want = unit["sensor_1"].rolling(7, min_periods=3).median()
        assert np.allclose(unit["sensor_1_median_w7"], want, equal_nan=True)


def test_many_frames_go_to_the_function_in_parts(readings, monkeypatch):
    df = readings({1: 50}, ("sensor_1",), noisy)
    want = custom.add_rolling(df, {"top": lambda h: np.nanmax(h, axis=1)}, 5).collect()
    monkeypatch.setattr(custom, "_FRAMES", 8)
    values = np.array([np.nan if r.sensor_1 is None else r.sensor_1 for r in sorted(want, key=lambda r: r.cycle)])
    held = custom.frames(values, 5)
    assert held.shape == (50, 5) and np.isnan(held[0, :4]).all()
    assert np.array_equal(held[10], values[6:11], equal_nan=True)


def test_a_function_sees_a_unit_in_cycle_order(fleet):
    def steps(piece):
        cycles = piece["cycle"].to_numpy()
        assert (np.diff(cycles) == 1).all() and len(set(piece["unit_id"].to_pylist())) == 1
        return {"nth": np.arange(1, len(cycles) + 1), "name": [f"c{c}" for c in cycles]}

    out = custom.add_from_function(
        fleet.repartition(7, "cycle"), steps, {"nth": T.LongType(), "name": T.StringType()}
    )
    assert out.where((F.col("nth") != F.col("cycle")) | (F.col("name") != F.concat(F.lit("c"), "cycle"))).count() == 0
    assert out.count() == fleet.count()


def test_wrong_lengths_are_told_empty_tables_and_clashing_names_work(fleet):
    with pytest.raises(Exception, match="1 values for"):
        custom.add_from_function(fleet, lambda piece: {"x": [1.0]}, {"x": T.DoubleType()}).collect()
    empty = custom.add_rolling(fleet.where("false"), {"mean": lambda h: np.nanmean(h, axis=1)}, 10)
    assert empty.collect() == [] and "sensor_1_mean_w10" in empty.columns
    doubled = fleet.withColumn("twice", F.lit("old"))
    out = custom.add_from_function(
        doubled, lambda piece: {"twice": piece["cycle"].to_numpy() * 2}, {"twice": T.LongType()}
    )
    assert out.where(F.col("twice") != F.col("cycle") * 2).count() == 0 and out.columns.count("twice") == 1


def test_units_dealt_out_before_are_not_moved_again(spark, fleet):
    placed = feat.add_features(fleet, ["sensor_1"], [10], [], hot=False)
    out = custom.add_rolling(placed, {"mean": lambda h: np.nanmean(h, axis=1)}, 10, ["sensor_1"], hot=False, dense=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
