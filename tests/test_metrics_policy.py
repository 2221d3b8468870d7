"""Metrics, decisions and intervals on hand values and against brute force."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import baseline, metrics, policy, uncertainty
from fleetgauge.schema import CostPolicy

DAY = dt.date(2026, 1, 1)


def scored(spark, y, s, rul=None):
    rul = rul if rul is not None else [0.0] * len(y)
    rows = [("m", int(a), float(b), float(c)) for a, b, c in zip(y, s, rul)]
    return spark.createDataFrame(rows, "model string, label_within_x int, risk double, rul double")


def bundle(spark, y, s):
    return metrics.classification_metrics(scored(spark, y, s), ["model"]).first()


def test_perfect_ranking(spark):
    row = bundle(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    assert row["pr_auc"] == 1.0 and row["recall_at_p80"] == 1.0 and row["f1"] == 1.0


def test_average_precision_with_ties(spark):
    row = bundle(spark, [0, 1, 0, 1, 1, 0, 0, 1], [0.1, 0.4, 0.35, 0.8, 0.4, 0.4, 0.7, 0.6])
    assert row["pr_auc"] == pytest.approx(0.75)


def test_unreachable_precision_gives_zero(spark):
    hist = metrics.score_histogram(scored(spark, [1, 1], [0.3, 0.4]), ["model"])
    assert metrics.ranking_metrics(hist, ["model"], 1.1).first()["recall_at_p80"] == 0.0


def test_no_positive_flagged(spark):
    assert bundle(spark, [1, 1], [0.1, 0.2])["f1"] == 0.0


def test_brier_extremes(spark):
    assert bundle(spark, [1, 0], [0.0, 1.0])["brier_score"] == 1.0
    assert bundle(spark, [1, 0], [1.0, 0.0])["brier_score"] == 0.0


def test_edge_value_falls_in_lower_bin(spark):
    hist = metrics.score_histogram(scored(spark, [0, 0, 0], [0.3, 1.0, 0.0]), ["model"])
    bins = sorted(r["bin"] for r in metrics.calibration_bins(hist, ["model"]).collect())
    assert bins == [0, 2, 9]


def test_bundle_against_brute_force(spark):
    rng = np.random.default_rng(5)
    s = rng.integers(0, 40, 300) / 40
    y = (rng.random(300) < s).astype(int)
    row = bundle(spark, y, s)
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        flagged = s >= t
        precision, recall = y[flagged].mean(), y[flagged].sum() / y.sum()
        ap, last = ap + (recall - last) * precision, recall
    index = np.clip(np.digitize(s, np.linspace(0, 1, 11)) - 1, 0, 9)
    ece = sum((index == b).sum() * abs(y[index == b].mean() - s[index == b].mean()) for b in set(index)) / 300
    assert row["pr_auc"] == pytest.approx(ap) and row["ece"] == pytest.approx(ece)
    assert row["brier_score"] == pytest.approx(((s - y) ** 2).mean())


def test_ungrouped_bundle_keys(spark):
    out = metrics.classification_metrics(scored(spark, [0, 1], [0.2, 0.7]), [])
    assert set(out.columns) == {"pr_auc", "recall_at_p80", "f1", "brier_score", "ece"}


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 0.0, 3.0), ("l", 10.0, 15.0), ("e", 10.0, 5.0)],
                               "g string, rul double, predicted_rul double")
    rows = {r["g"]: r for r in metrics.regression_metrics(df, ["g"]).collect()}
    assert rows["a"]["mae"] == 2.0 and rows["a"]["rmse"] == pytest.approx(math.sqrt(5))
    assert rows["l"]["asymmetric_penalty"] == 7.5 and rows["e"]["asymmetric_penalty"] == 5.0


def test_confusion_grid_is_complete(spark):
    out = metrics.confusion_matrix(scored(spark, [1, 1], [0.9, 0.1]))
    assert {(r["actual"], r["predicted"]): r["n"] for r in out.collect()} == {
        (0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 1
    }


ALERTS = [
    (0.9, 50, "critical"), (0.2, 5, "critical"), (0.1, 10, "critical"), (0.8, 100, "critical"),
    (0.6, 50, "high"), (0.5, 50, "high"), (0.35, 80, "scheduled"), (0.1, 200, "ok"),
]


def alert_rows(spark, rows, **kwargs):
    df = spark.createDataFrame(
        [("FD001", i, float(r), float(l)) for i, (r, l) in enumerate(rows)],
        "variant string, unit_id int, risk double, predicted_rul double",
    )
    return [r for r in policy.alerts(df, reference_date=DAY, **kwargs).orderBy("unit_id").collect()]


def test_urgency_levels(spark):
    found = alert_rows(spark, [(r, l) for r, l, _ in ALERTS])
    assert [r["urgency"] for r in found] == [u for _, _, u in ALERTS]
    assert alert_rows(spark, [(0.6, 100)], threshold=0.7)[0]["urgency"] == "scheduled"


def test_service_dates(spark):
    rows = alert_rows(spark, [(0.1, 30), (0.1, 0), (0.1, -5), (0.1, 1)])
    assert [r["days_until_service"] for r in rows] == [10, 0, 0, 1]
    assert rows[0]["recommended_service_date"] == "2026-01-11"


def test_message_rounds_half_to_even(spark):
    assert "Estimated RUL 12 cycles (5 days)" in alert_rows(spark, [(0.9, 12.5)])[0]["message"]


@pytest.mark.parametrize(
    "risk, action, cost",
    [(0.0, "continue", 0.0), (0.01, "continue", 500.0), (0.05, "inspect", 990.0), (0.31, "inspect", 3018.0),
     (0.5, "inspect", 4500.0), (0.9, "inspect", 7620.0), (0.949, "replace", 8000.0), (1.0, "replace", 8000.0),
     (1.7, "replace", 8000.0), (-1.0, "continue", 0.0)],
)
def test_actions(spark, risk, action, cost):
    row = policy.add_actions(spark.createDataFrame([(risk,)], "risk double")).first()
    assert row["action"] == action and row["expected_cost"] == pytest.approx(cost)


def test_sweep_against_brute_force(spark):
    rng = np.random.default_rng(2)
    s, y = rng.integers(0, 21, 200) / 20, rng.integers(0, 2, 200)
    rul = rng.integers(0, 31, 200).astype(float)
    table = {r["threshold"]: r for r in policy.sweep(scored(spark, y, s, rul), policy=CostPolicy()).collect()}
    assert len(table) == 17
    for t in np.linspace(0.1, 0.9, 17):
        row, hit = table[round(t, 3)], (s >= t) & (y == 1)
        assert row["alerts"] == (s >= t).sum() and row["prevented_failures"] == hit.sum()
        assert row["missed_failures"] == ((s < t) & (y == 1)).sum()
        assert row["mean_lead_time_cycles"] == pytest.approx(rul[hit].mean() if hit.any() else 0, abs=0.0051)
        assert row["median_lead_time_cycles"] == pytest.approx(np.median(rul[hit]) if hit.any() else 0)
    assert len({r["expected_cost"] for r in table.values()}) == 1


def test_sweep_without_alerts(spark):
    rows = policy.sweep(scored(spark, [1, 0], [0.0, 0.05])).collect()
    assert len(rows) == 17 and {r["mean_lead_time_cycles"] for r in rows} == {0.0}


def test_lead_time_cdf_keeps_ties_apart(spark, monkeypatch):
    monkeypatch.setattr(policy, "_EXPAND", 3)
    df = scored(spark, [1] * 12 + [0], [0.9] * 13, [5.0] * 10 + [1.0, 9.0, 2.0])
    rows = sorted((r["lead_time_cycles"], r["cdf"]) for r in policy.lead_time_cdf(df).collect())
    assert [r[0] for r in rows] == [1.0] + [5.0] * 10 + [9.0]
    assert [r[1] for r in rows] == pytest.approx([i / 12 for i in range(1, 13)])
    assert policy.median_lead_time(df).first()[0] == 5.0


def test_conformal_width(spark):
    rng = np.random.default_rng(4)
    p, y = rng.random(57), rng.integers(0, 2, 57)
    miss = np.where(y == 1, 1 - p, p)
    level = min(1.0, math.ceil(58 * 0.9) / 57)
    row = uncertainty.conformal_width(scored(spark, y, p)).first()
    assert row["q_hat"] == pytest.approx(np.quantile(miss, level))


def test_intervals_without_artifact_are_null(spark):
    df = scored(spark, [1], [0.4])
    assert uncertainty.add_risk_interval(df, None).first()["risk_lower"] is None
    row = uncertainty.add_risk_interval(df, 0.7).first()
    assert row["risk_lower"] == 0.0 and row["risk_upper"] == 1.0
    filled = uncertainty.add_rul_fallback(df).first()["predicted_rul"]
    assert filled == pytest.approx(204.0)


def test_residual_intervals_cover(spark):
    rng = np.random.default_rng(8)
    pred = rng.uniform(0, 100, 2000)
    rows = [(float(p), float(p + e)) for p, e in zip(pred, rng.normal(0, 5, 2000))]
    df = spark.createDataFrame(rows, "predicted_rul double, rul double")
    shifts = uncertainty.residual_quantiles(df, width=25.0)
    row = metrics.interval_coverage(uncertainty.add_rul_interval(df, shifts, 25.0), [], "rul", "rul_lower", "rul_upper").first()
    assert row["coverage"] == pytest.approx(0.8, abs=0.03)


def test_threshold_rule_direction(readings):
    from fleetgauge.operators.labels import add_binary_label, add_rul

    df = add_binary_label(add_rul(readings({1: 20, 2: 30}, ("sensor_1", "sensor_2"), lambda u, c, s: float(-c if s == "sensor_1" else 1)), False), 5)
    rule = baseline.fit_threshold_rule(df, ["sensor_1", "sensor_2"])
    assert rule.sensor == "sensor_1" and rule.direction == -1
    scores = rule.score(df)
    assert scores.agg(F.min("risk")).first()[0] >= 0 and scores.agg(F.max("risk")).first()[0] <= 1


def test_missing_risk_is_not_reported_as_healthy(spark):
    df = spark.createDataFrame([("FD001", 1, None, 200.0), ("FD001", 2, None, 5.0), ("FD001", 3, 0.1, 200.0)], "variant string, unit_id int, risk double, predicted_rul double")
    rows = policy.alerts(df, rul="predicted_rul").orderBy("unit_id").collect()
    assert [r.urgency for r in rows] == ["unknown", "critical", "ok"]
    assert rows[0].message == "Unit 1: no risk score available." and rows[0].action is None


def test_unseen_bucket_takes_overall_quantiles(spark):
    cal = spark.createDataFrame([(10.0, 12.0), (11.0, 10.0), (12.0, 15.0)], "predicted_rul double, rul double")
    df = spark.createDataFrame([(11.0,), (500.0,)], "predicted_rul double")
    shifts = uncertainty.residual_quantiles(cal)
    plain = uncertainty.add_rul_interval(df, shifts).orderBy("predicted_rul").collect()
    assert plain[0].rul_lower is not None and plain[1].rul_lower is None
    full = uncertainty.add_rul_interval(df, shifts, overall=uncertainty.overall_quantiles(cal)).orderBy("predicted_rul").collect()
    assert full[0] == plain[0] and 490 < full[1].rul_lower <= full[1].rul_upper < 510


def test_bundle_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = scored(spark, [0, 1] * 10, [i / 20 for i in range(20)])
    metrics.classification_metrics(rows.mapInArrow(counted, rows.schema), ["model"]).collect()
    assert seen.value == 20
