"""Queries over scored readings: metrics, baseline rule, intervals and maintenance policy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetgauge.operators import baseline, metrics, policy, splits, stats, uncertainty
from fleetgauge.functions.scalars import key_uniform, linspace, text_key
from fleetgauge.operators import features as feat
from fleetgauge.plans import bindings as view
from fleetgauge.plans.registry import FLEET, LABELLED, SCORED, as_int, query, r6, text_key_sql, uniform_sql
from fleetgauge.schema import KEYS, CostPolicy

DAY = dt.date(2026, 1, 1)


def rounded(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


# --- metrics ---------------------------------------------------------------------------------

CURVE = """h AS (SELECT {g}, risk, count(*) AS n, sum(label_within_x) AS pos FROM {t} GROUP BY {g}, risk),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS flagged, sum(pos) OVER (PARTITION BY {g}) AS p
  FROM h WINDOW w AS (PARTITION BY {g} ORDER BY risk DESC)),
pr AS (SELECT *, tp / CAST(flagged AS DOUBLE) AS prec, tp / CAST(p AS DOUBLE) AS rec,
  pos / CAST(p AS DOUBLE) AS step FROM curve)"""
_BY_VARIANT = CURVE.format(g="variant", t="scored")


def bin_sql(x: str) -> str:
    """Bin index from the raw edges of ten uniform bins."""
    edges = [repr(e) for e in linspace(0.0, 1.0, 11)]
    passed = " + ".join(f"CAST({x} >= {e}e0 AS INTEGER)" for e in edges)
    return f"greatest(0, least(9, {passed} - 1))"


@query("m1_pr_auc", f"WITH {SCORED}, {_BY_VARIANT} SELECT variant, {r6('sum(step * prec)')} AS pr_auc FROM pr GROUP BY 1")
def m1_pr_auc(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    return metrics.ranking_metrics(hist, ["variant"]).select("variant", *rounded("pr_auc"))


@query(
    "m2_recall_at_precision",
    f"""WITH {SCORED}, {_BY_VARIANT} SELECT variant,
    {r6("coalesce(max(rec) FILTER (prec >= 0.5), 0)")} AS recall FROM pr GROUP BY 1""",
)
def m2_recall_at_precision(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    out = metrics.ranking_metrics(hist, ["variant"], target_precision=0.5)
    return out.select("variant", F.round("recall_at_p80", 6).alias("recall"))


_F1 = """2e0 * sum(CAST(risk >= 0.5 AND label_within_x = 1 AS INTEGER)) /
  (sum(CAST(risk >= 0.5 AS INTEGER)) + sum(label_within_x))"""
_BRIER = "avg((risk - label_within_x) * (risk - label_within_x))"


@query(
    "m3_m6_f1_brier",
    f"WITH {SCORED} SELECT variant, {r6(_F1)} AS f1, {r6(_BRIER)} AS brier_score FROM scored GROUP BY 1",
)
def m3_m6_f1_brier(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    return metrics.threshold_metrics(hist, ["variant"]).select("variant", *rounded("f1", "brier_score"))


_ERR = """sum(abs(e)) / count(*) AS mae, sqrt(avg(e * e)) AS rmse,
  avg(CASE WHEN e > 0 THEN 1.5e0 ELSE 1e0 END * abs(e)) AS asym"""


@query(
    "m4_m5_regression_metrics",
    f"""WITH {SCORED}, e AS (SELECT variant, predicted_rul - rul AS e FROM scored),
    m AS (SELECT variant, {_ERR} FROM e GROUP BY 1)
    SELECT variant, {r6("mae")} AS mae, {r6("rmse")} AS rmse, {r6("asym")} AS asymmetric_penalty FROM m""",
)
def m4_m5_regression_metrics(spark, sf_dir):
    out = metrics.regression_metrics(view.scored(spark, sf_dir).df, ["variant"])
    return out.select("variant", *rounded("mae", "rmse", "asymmetric_penalty"))


_BINS = f"""b AS (SELECT variant, {bin_sql("risk")} AS bin, count(*) AS n, avg(label_within_x) AS acc,
  avg(risk) AS conf FROM scored GROUP BY 1, 2)"""


@query(
    "m7_ece",
    f"WITH {SCORED}, {_BINS} SELECT variant, {r6('sum(n * abs(acc - conf)) / sum(n)')} AS ece FROM b GROUP BY 1",
)
def m7_ece(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    return metrics.calibration_error(hist, ["variant"]).select("variant", *rounded("ece"))


@query(
    "m7_calibration_bins",
    f"""WITH {SCORED}, {_BINS} SELECT variant, bin, {as_int("n")} AS n, {r6("acc")} AS positive_rate,
    {r6("conf")} AS mean_score FROM b""",
)
def m7_calibration_bins(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    out = metrics.calibration_bins(hist, ["variant"])
    return out.select("variant", "bin", "n", *rounded("positive_rate", "mean_score"))


_MODELS = SCORED + """, models AS (SELECT variant, event_type AS model, risk, label_within_x FROM scored)"""
_MB = bin_sql("risk")


@query(
    "m8_classification_bundle",
    f"""WITH {_MODELS}, {CURVE.format(g="model, variant", t="models")},
    rk AS (SELECT model, variant, sum(step * prec) AS ap, coalesce(max(rec) FILTER (prec >= 0.8), 0) AS r80
      FROM pr GROUP BY 1, 2),
    b AS (SELECT model, variant, {_MB} AS bin, count(*) AS n, avg(label_within_x) AS acc, avg(risk) AS conf
      FROM models GROUP BY 1, 2, 3),
    ec AS (SELECT model, variant, sum(n * abs(acc - conf)) / sum(n) AS ece FROM b GROUP BY 1, 2),
    th AS (SELECT model, variant, {_F1} AS f1, {_BRIER} AS brier FROM models GROUP BY 1, 2)
    SELECT model, variant, {r6("ap")} AS pr_auc, {r6("r80")} AS recall_at_p80, {r6("f1")} AS f1,
      {r6("brier")} AS brier_score, {r6("ece")} AS ece
    FROM rk JOIN ec USING (model, variant) JOIN th USING (model, variant)""",
)
def m8_classification_bundle(spark, sf_dir):
    """All five metrics of every (model, variant) in one job."""
    df = view.scored(spark, sf_dir, ("event_type",)).df.withColumnRenamed("event_type", "model")
    out = metrics.classification_metrics(df, ["model", "variant"])
    return out.select("model", "variant", *rounded("pr_auc", "recall_at_p80", "f1", "brier_score", "ece"))


@query(
    "m8_document_metrics",
    f"""WITH doc AS (SELECT lang, toxic AS label_within_x,
      n_chars / CAST((SELECT max(n_chars) FROM documents) AS DOUBLE) AS risk
      FROM labels JOIN documents USING (doc_id)), {CURVE.format(g="lang", t="doc")},
    rk AS (SELECT lang, sum(step * prec) AS ap FROM pr GROUP BY 1),
    th AS (SELECT lang, {_BRIER} AS brier FROM doc GROUP BY 1)
    SELECT lang, {r6("ap")} AS pr_auc, {r6("brier")} AS brier_score FROM rk JOIN th USING (lang)""",
)
def m8_document_metrics(spark, sf_dir):
    out = metrics.classification_metrics(view.doc_scores(spark, sf_dir), ["lang"], "toxic", "risk")
    return out.select("lang", *rounded("pr_auc", "brier_score"))


@query(
    "m10_pr_curve",
    f"""WITH {SCORED}, {_BY_VARIANT} SELECT variant, {r6("risk")} AS threshold, {r6("prec")} AS precision,
    {r6("rec")} AS recall FROM pr""",
)
def m10_pr_curve(spark, sf_dir):
    hist = metrics.score_histogram(view.scored(spark, sf_dir).df, ["variant"])
    points = metrics.precision_recall_points(hist, ["variant"])
    return points.select("variant", *rounded("threshold", "precision", "recall"))


_OCTILES = ", ".join(f"quantile_cont(risk, {i / 8}) AS q{i}" for i in range(1, 8))
_OCTILE_BIN = " + ".join(f"CAST(risk > q{i} AS INTEGER)" for i in range(1, 8))


@query(
    "m11_reliability_curve",
    f"""WITH {SCORED}, q AS (SELECT {_OCTILES} FROM scored)
    SELECT {_OCTILE_BIN} AS bin, {as_int("count(*)")} AS n, {r6("avg(risk)")} AS mean_score,
    {r6("avg(label_within_x)")} AS positive_rate FROM scored, q GROUP BY 1""",
)
def m11_reliability_curve(spark, sf_dir):
    out = metrics.reliability_curve(view.scored(spark, sf_dir).df)
    return out.select("bin", "n", *rounded("mean_score", "positive_rate"))


@query(
    "m12_confusion_matrix",
    f"""WITH {SCORED}, g AS (SELECT a AS actual, p AS predicted FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(p))
    SELECT actual, predicted, {as_int("(SELECT count(*) FROM scored WHERE label_within_x = actual AND CAST(risk >= 0.5 AS INTEGER) = predicted)")} AS n FROM g""",
)
def m12_confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(view.scored(spark, sf_dir).df)


@query(
    "m13_residual_histogram",
    f"""WITH {SCORED}, e AS (SELECT predicted_rul - rul AS e FROM scored),
    b AS (SELECT min(e) AS lo, (max(e) - min(e)) / 20e0 AS wid FROM e)
    SELECT CAST(least(19, floor((e - lo) / wid)) AS INTEGER) AS bin,
      {r6("min(lo + least(19, floor((e - lo) / wid)) * wid)")} AS bin_low, {as_int("count(*)")} AS n
    FROM e, b GROUP BY 1""",
)
def m13_residual_histogram(spark, sf_dir):
    df = view.scored(spark, sf_dir).df
    residuals = df.select((F.col("predicted_rul") - F.col("rul")).alias("residual"))
    return stats.binned(residuals, "residual").select("bin", *rounded("bin_low"), "n")


@query(
    "m13_residual_bias",
    f"""WITH {SCORED} SELECT variant, {r6("avg(predicted_rul - rul)")} AS mean_residual,
    CASE WHEN avg(predicted_rul - rul) > 0 THEN 'over' ELSE 'under' END AS bias FROM scored GROUP BY 1""",
)
def m13_residual_bias(spark, sf_dir):
    mean = F.avg(F.col("predicted_rul") - F.col("rul"))
    out = view.scored(spark, sf_dir).df.groupBy("variant").agg(mean.alias("mean_residual"))
    bias = F.when(F.col("mean_residual") > 0, "over").otherwise("under").alias("bias")
    return out.select("variant", *rounded("mean_residual"), bias)


# --- baseline rule ---------------------------------------------------------------------------


@query(
    "y1_threshold_rule",
    f"""WITH {FLEET}, gl AS (SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN sensor_1 END AS sensor_1),
      max(cycle) OVER (PARTITION BY variant, unit_id) - cycle AS rul FROM fleet),
    tall AS (SELECT 'sensor_1' AS sensor, variant, unit_id, cycle, sensor_1 AS x, rul FROM gl
      UNION ALL SELECT 'sensor_2', variant, unit_id, cycle, sensor_2, rul FROM gl
      UNION ALL SELECT 'sensor_3', variant, unit_id, cycle, sensor_3, rul FROM gl),
    ranked AS (SELECT sensor,
      rank() OVER (PARTITION BY sensor ORDER BY x) + (count(*) OVER (PARTITION BY sensor, x) - 1) / 2e0 AS rx,
      rank() OVER (PARTITION BY sensor ORDER BY rul) + (count(*) OVER (PARTITION BY sensor, rul) - 1) / 2e0 AS ry
      FROM tall WHERE x IS NOT NULL),
    best AS (SELECT sensor FROM ranked GROUP BY 1 ORDER BY abs(corr(rx, ry)) DESC LIMIT 1),
    one AS (SELECT * FROM tall SEMI JOIN best USING (sensor)),
    d AS (SELECT avg(x) FILTER (rul <= 30) >= avg(x) FILTER (rul > 30) AS rising,
      quantile_cont(x, 0.5) AS med, min(x) AS lo, max(x) AS hi FROM one)
    SELECT variant, unit_id, cycle, {r6("CASE WHEN rising THEN coalesce(x, med) - lo ELSE hi - coalesce(x, med) END / (hi - lo + 1e-9)")} AS risk
    FROM one, d""",
)
def y1_threshold_rule(spark, sf_dir):
    """Select a sensor by rank correlation, fit direction, score by min-max."""
    fleet = view.labelled(view.gaps(spark, sf_dir))
    rule = baseline.fit_threshold_rule(fleet.df, view.FLEET_SENSORS)
    return rule.score(fleet.df).select(*KEYS, "cycle", *rounded("risk"))


@query(
    "y1_class_moments",
    f"""WITH {LABELLED} SELECT {r6("avg(sensor_1) FILTER (label_within_x = 1)")} AS positive_mean,
    {r6("stddev_samp(sensor_1) FILTER (label_within_x = 1)")} AS positive_std,
    {r6("avg(sensor_1) FILTER (label_within_x = 0)")} AS negative_mean FROM labelled""",
)
def y1_class_moments(spark, sf_dir):
    out = baseline.class_moments(view.labelled(view.fleet(spark, sf_dir)).df, "sensor_1")
    return out.select(*rounded("positive_mean", "positive_std", "negative_mean"))


# --- uncertainty -----------------------------------------------------------------------------

def _quantile_sql(value: str, level: str, groups: str, source: str) -> str:
    """Linear-interpolated quantile whose level may depend on the group."""
    return f"""(SELECT {groups}, max(x) FILTER (i = floor(h)) + (max(x) FILTER (i = ceil(h))
      - max(x) FILTER (i = floor(h))) * (max(h) - floor(max(h))) AS q FROM (
      SELECT {groups}, x, i, ({level}) * (n - 1) AS h FROM (
        SELECT {groups}, {value} AS x, row_number() OVER (PARTITION BY {groups} ORDER BY {value}) - 1 AS i,
          count(*) OVER (PARTITION BY {groups}) AS n FROM {source} WHERE {value} IS NOT NULL)) GROUP BY {groups})"""


_MISS = """miss AS (SELECT variant, CASE WHEN label_within_x = 1 THEN 1 - risk ELSE 1 - (1 - risk) END AS miss FROM scored)"""
_LEVEL = "least(1e0, ceil((n + 1) * 0.9e0) / n)"


@query(
    "c1_conformal_width",
    f"""WITH {SCORED}, {_MISS} SELECT variant, 0.1e0 AS alpha, {r6("q")} AS q_hat FROM
    {_quantile_sql("miss", _LEVEL, "variant", "miss")}""",
)
def c1_conformal_width(spark, sf_dir):
    out = uncertainty.conformal_width(view.scored(spark, sf_dir).df, ["variant"])
    return out.select("variant", "alpha", *rounded("q_hat"))


#: Half of the units each; a row's interval comes from the other half.
_FOLDED = SCORED.replace("scored AS (", "whole AS (") + f""", scored AS (SELECT *,
  CAST({uniform_sql(7, text_key_sql("variant"), "unit_id")} >= 0.5 AS INTEGER) AS fold FROM whole)"""


def _folded(spark, sf_dir):
    fold = (key_uniform(7, text_key(F.col("variant")), F.col("unit_id")) >= 0.5).cast("int")
    return view.scored(spark, sf_dir).df.withColumn("fold", fold)


def _other(table):
    """What one half of the units gives, for the rows of the other."""
    return table.withColumn("fold", F.lit(1) - F.col("fold"))


@query(
    "c2_risk_interval",
    f"""WITH {_FOLDED}, {_MISS.replace("SELECT variant", "SELECT fold")}, q AS {_quantile_sql("miss", _LEVEL, "fold", "miss")}
    SELECT variant, unit_id, cycle, {r6("greatest(0, least(1, risk - q))")} AS risk_lower,
    {r6("greatest(0, least(1, risk + q))")} AS risk_upper FROM scored s JOIN q ON s.fold = 1 - q.fold""",
)
def c2_risk_interval(spark, sf_dir):
    """Each half of the units takes the width that the other half calibrates."""
    df = _folded(spark, sf_dir)
    widths = _other(uncertainty.conformal_width(df, ["fold"])).select("fold", "q_hat")
    out = uncertainty.add_risk_interval(df.join(widths, "fold", "left"), F.col("q_hat"))
    return out.select(*KEYS, "cycle", *rounded("risk_lower", "risk_upper"))


@query(
    "c4_c5_fallback_and_flag",
    f"""WITH {SCORED} SELECT variant, unit_id, cycle, {r6("(1 - risk) * 340")} AS predicted_rul,
    risk >= 0.5 AS replace_within_30 FROM scored""",
)
def c4_c5_fallback_and_flag(spark, sf_dir):
    df = view.scored(spark, sf_dir).df.drop("predicted_rul")
    out = uncertainty.add_flag(uncertainty.add_rul_fallback(df))
    return out.select(*KEYS, "cycle", *rounded("predicted_rul"), "replace_within_30")


def _shift_sql(level: float) -> str:
    return _quantile_sql("res", f"{level}e0", "bucket", "res")


_RES = """res AS (SELECT CAST(floor(predicted_rul / 25e0) AS BIGINT) AS bucket, rul - predicted_rul AS res FROM scored)"""


@query(
    "y7_residual_quantiles",
    f"""WITH {SCORED}, {_RES} SELECT bucket, {as_int("n")} AS n, {r6("l.q")} AS shift_low, {r6("h.q")} AS shift_high
    FROM {_shift_sql(0.1)} l JOIN {_shift_sql(0.9)} h USING (bucket)
    JOIN (SELECT bucket, count(*) AS n FROM res GROUP BY 1) USING (bucket)""",
)
def y7_residual_quantiles(spark, sf_dir):
    out = uncertainty.residual_quantiles(view.scored(spark, sf_dir).df, width=25.0)
    return out.select("bucket", "n", *rounded("shift_low", "shift_high"))


def _fold_shift(level: float, groups: str) -> str:
    return _quantile_sql("res", f"{level}e0", groups, "res")


_INTERVALS = f"""{_RES.replace("SELECT CAST", "SELECT fold, CAST")},
  lo AS {_fold_shift(0.1, "fold, bucket")}, hi AS {_fold_shift(0.9, "fold, bucket")},
  lo_all AS {_fold_shift(0.1, "fold")}, hi_all AS {_fold_shift(0.9, "fold")},
  iv AS (SELECT variant, unit_id, cycle, rul, greatest(0, predicted_rul + coalesce(lo.q, lo_all.q)) AS lo,
  greatest(0, predicted_rul + coalesce(hi.q, hi_all.q)) AS hi FROM scored s
  LEFT JOIN lo ON s.fold = 1 - lo.fold AND floor(predicted_rul / 25e0) = lo.bucket
  LEFT JOIN hi ON s.fold = 1 - hi.fold AND floor(predicted_rul / 25e0) = hi.bucket
  LEFT JOIN lo_all ON s.fold = 1 - lo_all.fold LEFT JOIN hi_all ON s.fold = 1 - hi_all.fold)"""


@query(
    "c3_rul_interval",
    f"WITH {_FOLDED}, {_INTERVALS} SELECT variant, unit_id, cycle, {r6('lo')} AS rul_lower, {r6('hi')} AS rul_upper FROM iv",
)
def c3_rul_interval(spark, sf_dir):
    out = _intervals(spark, sf_dir)
    return out.select(*KEYS, "cycle", *rounded("rul_lower", "rul_upper"))


def _intervals(spark, sf_dir):
    """Each half of the units takes the residual quantiles of the other half."""
    df = _folded(spark, sf_dir)
    shifts = _other(uncertainty.residual_quantiles(df, width=25.0, groups=["fold"]))
    overall = _other(uncertainty.overall_quantiles(df, groups=["fold"]))
    return uncertainty.add_rul_interval(df, shifts, 25.0, ["fold"], overall)


@query(
    "m14_interval_coverage",
    f"""WITH {_FOLDED}, {_INTERVALS} SELECT variant, {as_int("count(*)")} AS n,
    {r6("avg(CAST(rul BETWEEN lo AND hi AS INTEGER))")} AS coverage, {r6("avg(hi - lo)")} AS mean_width FROM iv GROUP BY 1""",
)
def m14_interval_coverage(spark, sf_dir):
    out = metrics.interval_coverage(_intervals(spark, sf_dir), ["variant"], "rul", "rul_lower", "rul_upper")
    return out.select("variant", "n", *rounded("coverage", "mean_width"))


@query(
    "y12_pass_statistics",
    f"""WITH {SCORED} SELECT variant, unit_id, {as_int("count(*)")} AS n_passes, {r6("avg(risk)")} AS risk_mean,
    {r6("stddev_pop(risk)")} AS risk_std FROM scored GROUP BY 1, 2""",
)
def y12_pass_statistics(spark, sf_dir):
    """Mean and population deviation of repeated scores per unit."""
    out = uncertainty.pass_statistics(view.scored(spark, sf_dir).df, KEYS)
    return out.select(*KEYS, "n_passes", *rounded("risk_mean", "risk_std"))


# --- policy ----------------------------------------------------------------------------------

_COSTS = """costs AS (SELECT *, 8000e0 AS c_r, 400 + risk * 8000 + (1 - risk) * 200 AS c_i, risk * 50000 AS c_c FROM {t})"""
_CHOICE = """CASE WHEN c_r <= c_i AND c_r <= c_c THEN 'replace' WHEN c_i <= c_c THEN 'inspect' ELSE 'continue' END"""


@query(
    "k1_cheapest_action",
    f"""WITH {SCORED}, {_COSTS.format(t="scored")} SELECT variant, unit_id, cycle, {r6("c_i")} AS cost_inspect,
    {r6("c_c")} AS cost_continue, {_CHOICE} AS action, {r6("least(c_r, c_i, c_c)")} AS expected_cost FROM costs""",
)
def k1_cheapest_action(spark, sf_dir):
    out = policy.add_actions(view.scored(spark, sf_dir).df)
    return out.select(*KEYS, "cycle", *rounded("cost_inspect", "cost_continue"), "action", *rounded("expected_cost"))


def _alert_sql(source: str, per_day: int = 3) -> str:
    lead = "' Estimated RUL ' || CAST(CAST(round_even(left_, 0) AS BIGINT) AS VARCHAR) || ' cycles (' || days || ' days). '"
    return f"""al AS (SELECT *, CAST(ceil(left_ / {per_day}e0) AS INTEGER) AS days FROM (
        SELECT *, greatest(0, predicted_rul) AS left_ FROM {source})),
    ald AS (SELECT *, strftime(DATE '2026-01-01' + days, '%Y-%m-%d') AS day,
      CASE WHEN risk >= 0.8 OR left_ <= 10 THEN 'critical' WHEN risk >= 0.5 THEN 'high'
           WHEN risk >= 0.3 THEN 'scheduled' ELSE 'ok' END AS urgency,
      8000e0 AS c_r, 400 + risk * 8000 + (1 - risk) * 200 AS c_i, risk * 50000 AS c_c FROM al),
    alerts AS (SELECT variant, unit_id, cycle, round_even(risk, 4) AS risk_score,
      round_even(left_, 1) AS estimated_rul_cycles, urgency, day AS recommended_service_date,
      days AS days_until_service,
      CASE urgency
        WHEN 'critical' THEN 'Unit ' || unit_id || ': CRITICAL — immediate inspection required.' || {lead} || 'Recommend service by ' || day || '.'
        WHEN 'high' THEN 'Unit ' || unit_id || ': HIGH RISK — schedule maintenance soon.' || {lead} || 'Recommended service date: ' || day || '.'
        WHEN 'scheduled' THEN 'Unit ' || unit_id || ': EARLY WARNING — plan service within schedule.' || {lead} || 'Next service window: ' || day || '.'
        ELSE 'Unit ' || unit_id || ': operating normally. Next check in ' || days || ' days.' END AS message,
      {_CHOICE} AS action, round_even(least(c_r, c_i, c_c), 2) AS expected_cost FROM ald)"""


@query("k2_service_alerts", f"WITH {SCORED}, {_alert_sql('scored')} SELECT * FROM alerts")
def k2_service_alerts(spark, sf_dir):
    df = view.scored(spark, sf_dir).df
    return policy.alerts(df, reference_date=DAY, keep=(*KEYS, "cycle"))


_SWEEP_T = ", ".join(f"({i}, {repr(t)}e0)" for i, t in enumerate(policy.SWEEP))
_SWEEP = f"""t AS (SELECT * FROM (VALUES {_SWEEP_T}) v(i, t)),
  c AS (SELECT *, least(8000, 400 + risk * 8000 + (1 - risk) * 200, risk * 50000) AS best,
    least(8000, 400 + risk * 8000 + (1 - risk) * 200) AS service, risk * 50000 AS carry FROM scored),
  sweep AS (SELECT variant, round_even(t, 3) AS threshold, {as_int("count(*) FILTER (risk >= t)")} AS alerts,
    {as_int("count(*) FILTER (risk < t AND label_within_x = 1)")} AS missed_failures,
    {as_int("count(*) FILTER (risk >= t AND label_within_x = 1)")} AS prevented_failures,
    {as_int("count(*) FILTER (risk >= t AND label_within_x = 0)")} AS false_service_calls,
    round_even(coalesce(avg(rul) FILTER (risk >= t AND label_within_x = 1), 0), 2) AS mean_lead_time_cycles,
    round_even(coalesce(quantile_cont(CAST(rul AS DOUBLE), 0.5) FILTER (risk >= t AND label_within_x = 1), 0), 2)
      AS median_lead_time_cycles,
    round_even(avg(best), 2) AS expected_cost,
    round_even(avg(CASE WHEN risk >= t THEN service ELSE carry END), 2) AS cost_at
    FROM c, t GROUP BY variant, t)"""


@query("k3_threshold_sweep", f"WITH {SCORED}, {_SWEEP} SELECT * EXCLUDE (cost_at) FROM sweep")
def k3_threshold_sweep(spark, sf_dir):
    return policy.sweep(view.scored(spark, sf_dir).df, ["variant"], policy=CostPolicy())


@query(
    "k3_threshold_dependent_cost",
    f"WITH {SCORED}, {_SWEEP} SELECT variant, threshold, cost_at AS expected_cost FROM sweep",
)
def k3_threshold_dependent_cost(spark, sf_dir):
    out = policy.sweep(view.scored(spark, sf_dir).df, ["variant"], policy=CostPolicy(), cost_by_threshold=True)
    return out.select("variant", "threshold", "expected_cost")


@query(
    "k4_cheapest_threshold",
    f"""WITH {SCORED}, {_SWEEP} SELECT variant, arg_min(threshold, (cost_at, threshold)) AS threshold,
    min(cost_at) AS expected_cost FROM sweep GROUP BY 1""",
)
def k4_cheapest_threshold(spark, sf_dir):
    out = policy.sweep(view.scored(spark, sf_dir).df, ["variant"], policy=CostPolicy(), cost_by_threshold=True)
    return policy.cheapest_threshold(out, ["variant"])


_TP = "tp AS (SELECT variant, CAST(rul AS DOUBLE) AS lead FROM scored WHERE risk >= 0.5 AND label_within_x = 1)"


@query(
    "k5_lead_time_cdf",
    f"""WITH {SCORED}, {_TP} SELECT variant, lead AS lead_time_cycles,
    {r6("row_number() OVER (PARTITION BY variant ORDER BY lead) / CAST(count(*) OVER (PARTITION BY variant) AS DOUBLE)")} AS cdf FROM tp""",
)
def k5_lead_time_cdf(spark, sf_dir):
    out = policy.lead_time_cdf(view.scored(spark, sf_dir).df, ["variant"])
    return out.select("variant", "lead_time_cycles", *rounded("cdf"))


@query(
    "k6_median_lead_time",
    f"""WITH {SCORED}, {_TP}, c AS (SELECT variant, lead, row_number() OVER (PARTITION BY variant ORDER BY lead) /
      CAST(count(*) OVER (PARTITION BY variant) AS DOUBLE) AS cdf FROM tp)
    SELECT variant, min(lead) FILTER (cdf >= 0.5) AS median_lead_time FROM c GROUP BY 1""",
)
def k6_median_lead_time(spark, sf_dir):
    return policy.median_lead_time(view.scored(spark, sf_dir).df, ["variant"])


@query(
    "k7_monotone_check",
    f"""WITH {SCORED}, s AS (SELECT t, count(*) FILTER (risk >= t) AS a, count(*) FILTER (risk < t AND label_within_x = 1) AS m
      FROM scored, (VALUES {_SWEEP_T}) v(i, t) GROUP BY t),
    d AS (SELECT a > lag(a) OVER (ORDER BY t) OR m < lag(m) OVER (ORDER BY t) AS bad FROM s)
    SELECT {as_int("count(*)")} AS n_steps, {as_int("count(*) FILTER (bad)")} AS n_violations FROM d""",
)
def k7_monotone_check(spark, sf_dir):
    out = policy.sweep(view.scored(spark, sf_dir).df)
    return metrics.monotone_violations(out, "threshold", "alerts", "missed_failures")


_TRACKS = SCORED + """, tracks AS (SELECT CASE WHEN variant IN ('FD001', 'FD003') THEN 'A' ELSE 'B' END AS track, * FROM scored)"""


@query(
    "m9_business_table",
    f"""WITH {_TRACKS} SELECT track, {as_int("count(*) FILTER (risk >= 0.5)")} AS alerts,
    {as_int("count(*) FILTER (risk < 0.5 AND label_within_x = 1)")} AS missed_failures,
    {as_int("count(*) FILTER (risk >= 0.5 AND label_within_x = 1)")} AS prevented_failures,
    {as_int("count(*) FILTER (risk >= 0.5 AND label_within_x = 0)")} AS false_service_calls FROM tracks GROUP BY 1""",
)
def m9_business_table(spark, sf_dir):
    """One threshold of the sweep for two tracks, united with a tag."""
    split = splits.domain_split(view.scored(spark, sf_dir).df, [], scale=False)
    both = [
        policy.sweep(side).where("round(threshold, 2) = 0.5").withColumn("track", F.lit(track))
        for track, side in (("A", split.train), ("B", split.test))
    ]
    out = both[0].unionByName(both[1])
    return out.select("track", "alerts", "missed_failures", "prevented_failures", "false_service_calls")


def _smooth(column: str):
    return 1.0 / (1.0 + F.exp((50.0 - F.col(column)) / 10.0))


@query(
    "k8_fleet_schedule",
    f"""WITH {LABELLED}, f AS (SELECT variant, unit_id, cycle, avg(sensor_2) OVER (PARTITION BY variant, unit_id
      ORDER BY cycle ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS m FROM labelled),
    last AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY variant, unit_id ORDER BY cycle DESC) = 1),
    s AS (SELECT variant, unit_id, cycle, 1 / (1 + exp((50 - m) / 10)) AS risk FROM last),
    sc AS (SELECT *, (1 - risk) * 340 AS predicted_rul FROM s), {_alert_sql("sc")}
    SELECT * EXCLUDE (cycle) FROM alerts""",
)
def k8_fleet_schedule(spark, sf_dir):
    """Flagship: features, last reading per unit, score, schedule, worst first by unit."""
    fleet = view.labelled(view.fleet(spark, sf_dir))
    enriched = feat.add_features(fleet.df, ["sensor_2"], windows=[10], lags=[1], hot=fleet.hot, dense=True)
    last = feat.last_rows(enriched.select(*KEYS, "cycle", "sensor_2_mean_w10"))
    scored = uncertainty.add_rul_fallback(last.withColumn("risk", _smooth("sensor_2_mean_w10")))
    return policy.alerts(scored, reference_date=DAY).orderBy("variant", "unit_id")
