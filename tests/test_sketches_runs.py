import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import metrics, policy, rules, runs, sketches


def test_merged_sketches_answer_near_the_exact_ones(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.exponential(5.0, 20_000)
    df = spark.createDataFrame([(f"g{i % 2}", i % 7, float(v), i % 3000) for i, v in enumerate(x)], "g string, day int, v double, u int")
    path = str(tmp_path / "s")
    for day in range(7):
        sketches.append_sketches(sketches.sketched(df.where(F.col("day") == day), ["g", "day"], "v", "u"), path, "day")
    levels = {"lo": 0.05, "mid": 0.5, "hi": 0.99}
    found = sketches.answers(sketches.merged(sketches.read_sketches(spark, path), ["g"]), levels)
    for r in found.collect():
        own = np.sort(x[int(r["g"][1]) :: 2])
        assert r["n_rows"] == 10_000 and abs(r["n_members"] - 1500) < 75
        for name, q in levels.items():
            assert abs(np.searchsorted(own, r[name]) / len(own) - q) < 0.03
    errors = {r["g"]: r["rank_error"] for r in sketches.rank_errors(found, df, ["g"], "v", levels).collect()}
    assert set(errors) == {"g0", "g1"} and max(errors.values()) < 0.03


def test_sketches_of_missing_values(spark):
    df = spark.createDataFrame([("a", None, None), ("a", None, 1)], "g string, v double, u int")
    row = sketches.answers(sketches.merged(sketches.sketched(df, ["g"], "v", "u"), ["g"]), {"q": 0.5}).first()
    assert (row["n_rows"], row["q"], row["n_members"]) == (2, None, 1)
    assert sketches.sketched(df.limit(0), ["g"], "v", "u").count() == 0


def test_runs_of_scored_models_and_repeated_appends(spark, tmp_path):
    rows = [(m, t, v, i % 2, (i % 2) * s + (i % 5) / 50) for m, s in (("good", 0.9), ("bad", 0.0)) for t in "AB" for v in ("FD001", "FD002") for i in range(20)]
    scored = spark.createDataFrame(rows, "model string, track string, variant string, label_within_x int, risk double")
    found = runs.evaluated_runs(scored, {"good": {"depth": "3"}}, F.lit(dt.datetime(2026, 1, 1)))
    assert found.count() == 4 and found.select("run_id").distinct().count() == 4
    path = str(tmp_path / "runs")
    for _ in range(3):
        runs.append_new_runs(found, path)
    runs.append_new_runs(runs.evaluated_runs(scored, {}, F.lit(dt.datetime(2026, 1, 2))), path)
    table = runs.scan_runs(spark, path)
    assert table.count() == 8
    own = metrics.classification_metrics(scored, ["model", "track", "variant"]).where("model = 'good' AND track = 'B' AND variant = 'FD002'").first()
    row = runs.comparison(table).where("model = 'good' AND variant = 'FD002'").first()
    assert row["B_pr_auc"] == own["pr_auc"] and row["B_ece"] == own["ece"]
    best = runs.best_per_metric(runs.latest(runs.comparison(table)), ["A_pr_auc", "B_f1"]).collect()
    assert {r["model"] for r in best} == {"good"}
    assert {r["params"].get("depth") for r in table.where("run_name = 'good'").collect()} == {"3", None}


def test_absent_columns_duplicates_and_empty_rows_are_violations(spark):
    df = spark.createDataFrame([("FD001", 1, 1, 5.0), ("FD001", 1, 1, 6.0), ("FD001", 1, 2, 5.0), ("FD001", None, None, None)], "variant string, unit_id int, cycle int, sensor_1 double")
    some = [rules.Range("unit_id", 0), rules.Range("sensor_1"), rules.Range("sensor_9", required=False)]
    good, bad = rules.quarantine(df, some)
    assert good.count() == 2 and sorted(r["broken"] for r in bad.collect()) == [["unique"], ["unit_id", "sensor_1", "all_missing"]]
    absent = [rules.Range("sensor_2", 0.0, 1.0)]
    assert rules.violations(df, absent).count() == 4 and not any(r["is_valid"] for r in rules.mark_valid(df, absent).collect())
    assert rules.mark_valid(df, rules.rules_for(df, absent)).where("is_valid").count() == 4
    kept = rules.validate(df, some, mode="lenient")
    assert kept.count() == 4 and kept.where("is_valid").count() == 2
    repeated = spark.createDataFrame([("FD001", 1, 1, 5.0)] * 4, df.schema)
    assert [r["broken"] for r in rules.mark_all(repeated, some).collect()].count(["unique"]) == 3


def test_a_risk_of_nan_is_unknown(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 0.9)], "unit_id int, risk double").withColumns({"variant": F.lit("FD001"), "predicted_rul": F.lit(300.0)})
    got = {r["unit_id"]: r["urgency"] for r in policy.alerts(df, reference_date=dt.date(2026, 1, 1)).collect()}
    assert got == {1: "unknown", 2: "unknown", 3: "critical"}


def test_rows_without_interval_are_counted_apart(spark):
    df = spark.createDataFrame([(5.0, 1.0, 9.0), (5.0, 6.0, 9.0), (5.0, None, 9.0), (None, 1.0, 9.0)], "y double, lo double, hi double")
    row = metrics.interval_coverage(df, [], "y", "lo", "hi").first()
    assert (row["n"], row["n_without"], row["coverage"], row["mean_width"]) == (2, 2, 0.5, 5.5)
