"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
CHOSEN = [
    "k8_fleet_schedule", "w5_long_features", "x1_unit_holdout", "m8_classification_bundle",
    "k3_threshold_sweep", "q2_missing_spikes", "d1_drift_distances", "g4_regressor_table",
    "s1_text_readings", "st1_stream_scoring", "v5_quarantine", "y7_leaf_quantiles", "y14_permutation",
    "d1_category_drift", "a11_a12_stored_sketches", "y12_stochastic_passes",
]

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="tables are not here")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    outcome = check.compare(entry.queries()[name](spark, SF), check.connect(SF), entry.oracle_sql()[name])
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome


def test_entry_is_the_schedule(spark):
    rows = entry.entry(spark).collect()
    keys = [(r["variant"], r["unit_id"]) for r in rows]
    assert keys == sorted(keys) and len(keys) == 15


@pytest.mark.parametrize("name", ["k8_fleet_schedule", "w3_rolling_slope", "y8_survival_rows"])
def test_query_with_oversized_units(spark, name, monkeypatch):
    """The same results when units are treated as too large for one task."""
    from fleetgauge.plans import bindings

    monkeypatch.setattr(bindings, "oversized", lambda *a, **k: True)
    outcome = check.compare(entry.queries()[name](spark, SF), check.connect(SF), entry.oracle_sql()[name])
    assert outcome.startswith("ok"), outcome


def test_ids_above_32_bits_and_one_exchange(spark, tmp_path):
    """A view's units keep 64-bit ids; numbering and features share the exchange by user."""
    from pyspark.sql import functions as F

    from fleetgauge.operators import features as feat
    from fleetgauge.plans import bindings as view

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    far = events.withColumn("user_id", F.col("user_id") + 3_000_000_000)
    far.write.parquet(str(tmp_path / "events.parquet"))
    fleet = view.fleet(spark, str(tmp_path))
    assert fleet.df.agg(F.min("unit_id")).first()[0] >= 3_000_000_000
    out = feat.add_features(fleet.df, ["sensor_2"], [10], [1], hot=fleet.hot, dense=True)
    assert out.count() == events.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
