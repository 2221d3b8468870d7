"""Queries that watch data: quality alerts, drift, corruption, and the run table."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from fleetgauge.functions.scalars import clip
from fleetgauge.operators import corrupt, drift, metrics, quality, runs, splits
from fleetgauge.plans import bindings as view
from fleetgauge.plans.decisions import CURVE, bin_sql
from fleetgauge.plans.registry import (
    FLEET, FROZEN, GAPS, SCORED, WIDE, as_int, query, r6, text_key_sql, uniform_sql,
)
from fleetgauge.schema import KEYS
from fleetgauge.session import scratch_path
from fleetgauge.sources import tables


def rounded(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


# --- quality ---------------------------------------------------------------------------------

_SENSORS = view.FLEET_SENSORS


def _tall_sql(source: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT variant, unit_id, cycle, '{s}' AS sensor, {s} AS x FROM {source}" for s in _SENSORS
    )
    return f"tall AS ({parts})"


_SERIES = "PARTITION BY variant, unit_id, sensor ORDER BY cycle ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"
_FLAT = f"""fl AS (SELECT *, CASE WHEN count(x) OVER w >= 5 THEN stddev_samp(x) OVER w END < 1e-4 AS flag
    FROM tall WINDOW w AS ({_SERIES.format(n=9)})),
  flat AS (SELECT 'flatline' AS type, variant, unit_id, sensor, {as_int("count(*)")} AS n_cycles,
    list(cycle ORDER BY cycle)[1:20] AS cycles FROM fl WHERE flag GROUP BY ALL)"""
_SPIKE = f"""sp AS (SELECT *, avg(CAST(x IS NULL AS INTEGER)) OVER w AS rate
    FROM tall WINDOW w AS ({_SERIES.format(n=19)})),
  spike AS (SELECT 'missing_spike' AS type, variant, unit_id, sensor, {as_int("count(*) FILTER (rate > 0.05)")} AS n_cycles,
    round_even(max(rate), 4) AS max_nan_rate, list(cycle ORDER BY cycle) FILTER (rate > 0.05)[1:20] AS cycles
    FROM sp GROUP BY variant, unit_id, sensor HAVING count(*) FILTER (rate > 0.05) > 0)"""


@query("q1_flatline_alerts", f"WITH {FROZEN}, {_tall_sql('frozen')}, {_FLAT} SELECT * FROM flat")
def q1_flatline_alerts(spark, sf_dir):
    fleet = view.frozen(spark, sf_dir)
    return quality.flatline_alerts(fleet.df, _SENSORS, hot=fleet.hot, dense=True)


@query("q2_missing_spikes", f"WITH {GAPS}, {_tall_sql('gaps')}, {_SPIKE} SELECT * FROM spike")
def q2_missing_spikes(spark, sf_dir):
    fleet = view.gaps(spark, sf_dir)
    return quality.spike_alerts(fleet.df, _SENSORS, hot=fleet.hot, dense=True)


@query(
    "q3_quality_totals",
    f"""WITH {GAPS}, both_ AS (SELECT * REPLACE
      (CASE WHEN unit_id % 10 = 0 AND cycle >= 20 THEN 7 ELSE sensor_2 END AS sensor_2) FROM gaps),
    {_tall_sql("both_")}, {_FLAT}, {_SPIKE}
    SELECT {as_int("(SELECT count(*) FROM flat) + (SELECT count(*) FROM spike)")} AS total_alerts,
    {as_int("(SELECT count(*) FROM flat)")} AS flatline_alerts, {as_int("(SELECT count(*) FROM spike)")} AS missing_spike_alerts""",
)
def q3_quality_totals(spark, sf_dir):
    return quality.alert_totals(_all_alerts(spark, sf_dir))


def _all_alerts(spark, sf_dir):
    fleet = view.gaps(spark, sf_dir)
    stuck = (F.col("unit_id") % 10 == 0) & (F.col("cycle") >= 20)
    df = fleet.df.withColumn("sensor_2", F.when(stuck, F.lit(7.0)).otherwise(F.col("sensor_2")))
    return quality.quality_alerts(df, _SENSORS, hot=fleet.hot, dense=True)


@query(
    "s6_json_alerts",
    f"WITH {FROZEN}, {_tall_sql('frozen')}, {_FLAT} SELECT variant, unit_id, sensor, n_cycles, cycles FROM flat",
)
def s6_json_alerts(spark, sf_dir):
    """Alerts written as JSON and read back with their schema."""
    alerts = q1_flatline_alerts(spark, sf_dir)
    path = scratch_path(spark, "alerts")
    tables.write_json(alerts, path)
    return tables.read_json(spark, path, alerts.schema).select(*KEYS, "sensor", "n_cycles", "cycles")


# --- drift -----------------------------------------------------------------------------------

_DRIFT_COLUMNS = ["sensor_1", "sensor_2", "sensor_3"]
_DRIFT = f"""v AS (SELECT sensor AS feature, x AS value, count(*) FILTER (variant IN ('FD001', 'FD003')) AS r,
    count(*) FILTER (variant IN ('FD002', 'FD004')) AS c FROM tall WHERE x IS NOT NULL GROUP BY 1, 2),
  cum AS (SELECT feature, value, sum(r) OVER w / CAST(sum(r) OVER (PARTITION BY feature) AS DOUBLE) AS f,
    sum(c) OVER w / CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS g,
    lead(value) OVER (PARTITION BY feature ORDER BY value) - value AS step
    FROM v WINDOW w AS (PARTITION BY feature ORDER BY value)),
  sd AS (SELECT sensor AS feature, stddev_pop(x) AS s, count(*) AS n_ref FROM tall
    WHERE variant IN ('FD001', 'FD003') AND x IS NOT NULL GROUP BY 1),
  nc AS (SELECT sensor AS feature, count(*) AS n_cur FROM tall
    WHERE variant IN ('FD002', 'FD004') AND x IS NOT NULL GROUP BY 1),
  dist AS (SELECT feature, max(n_ref) AS n_ref, max(n_cur) AS n_cur, max(abs(f - g)) AS ks,
    sum(abs(f - g) * step) / max(s) AS w FROM cum JOIN sd USING (feature) JOIN nc USING (feature) GROUP BY 1)"""


@query(
    "d1_drift_distances",
    f"""WITH {GAPS}, {_tall_sql("gaps")}, {_DRIFT} SELECT feature, {as_int("n_ref")} AS n_reference,
    {as_int("n_cur")} AS n_current, {r6("ks")} AS ks, {r6("w")} AS wasserstein FROM dist""",
)
def d1_drift_distances(spark, sf_dir):
    split = splits.domain_split(view.gaps(spark, sf_dir).df, [], scale=False)
    out = drift.drift_distances(split.train, split.test, _DRIFT_COLUMNS)
    return out.select("feature", "n_reference", "n_current", *rounded("ks", "wasserstein"))


@query(
    "d1_drift_summary",
    f"""WITH {GAPS}, {_tall_sql("gaps")}, {_DRIFT} SELECT {as_int("count(*)")} AS total_features,
    {as_int("count(*) FILTER (w >= 0.01)")} AS drifted_features, round_even(avg(CAST(w >= 0.01 AS INTEGER)), 4) AS drift_share,
    coalesce(list(feature ORDER BY feature) FILTER (w >= 0.01), []) AS drifted_columns FROM dist""",
)
def d1_drift_summary(spark, sf_dir):
    split = splits.domain_split(view.gaps(spark, sf_dir).df, [], scale=False)
    report = drift.drift_report(
        split.train, split.test, _DRIFT_COLUMNS, method="wasserstein", distance=0.01
    )
    return drift.drift_summary(report)


_WIDE_TALL = "tall AS (" + " UNION ALL ".join(
    f"SELECT CASE WHEN variant IN ('ASIA', 'EUROPE') THEN 'FD001' ELSE 'FD002' END AS variant, '{s}' AS sensor, {s} AS x FROM wide"
    for s in view.WIDE_SENSORS
) + ")"
_TERMS = " ".join(
    f"{'+' if k % 2 else '-'} exp(-2e0 * {k * k} * lam * lam)" for k in range(1, 51)
)


@query(
    "d1_drift_ks_wide",
    f"""WITH {WIDE}, {_WIDE_TALL}, {_DRIFT},
    l AS (SELECT *, ks * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS lam FROM dist),
    p AS (SELECT *, CASE WHEN lam < 0.2 THEN 1 ELSE greatest(0, least(1, 2 * (0e0 {_TERMS}))) END AS p FROM l)
    SELECT feature, {r6("ks")} AS ks, {r6("p")} AS p_value, p < 0.05 AS drifted FROM p""",
)
def d1_drift_ks_wide(spark, sf_dir):
    """Rank-test drift between two groups of regions, every feature in one job."""
    df = view.wide(spark, sf_dir).df
    split = splits.domain_split(
        df, [], ("ASIA", "EUROPE"), ("AFRICA", "AMERICA", "MIDDLE EAST"), scale=False
    )
    out = drift.drift_report(split.train, split.test, view.WIDE_SENSORS, method="ks")
    return out.select("feature", *rounded("ks", "p_value"), "drifted")


_CATEGORIES = {"event_type": "event_type", "weekday": "CAST(weekday({t}) AS VARCHAR)", "shift": "CAST(hour({t}) // 8 AS VARCHAR)"}
_CATEGORY_COUNTS = """c AS ({parts}), k AS (SELECT half, feature, category, sum(r) AS r, sum(1 - r) AS q FROM c GROUP BY 1, 2, 3),
    s AS (SELECT *, sum(r) OVER w AS nr, sum(q) OVER w AS nq, count(*) OVER w AS k FROM k WINDOW w AS (PARTITION BY half, feature)),
    d AS (SELECT half, feature, nr, nq, k,
      sum(pow(r - nr * (r + q) / CAST(nr + nq AS DOUBLE), 2) / (nr * (r + q) / CAST(nr + nq AS DOUBLE))
        + pow(q - nq * (r + q) / CAST(nr + nq AS DOUBLE), 2) / (nq * (r + q) / CAST(nr + nq AS DOUBLE))) AS chi,
      sum(CASE WHEN r > 0 THEN 0.5e0 * r / nr * log2(2e0 * r / nr / (r / CAST(nr AS DOUBLE) + q / CAST(nq AS DOUBLE))) ELSE 0 END
        + CASE WHEN q > 0 THEN 0.5e0 * q / nq * log2(2e0 * q / nq / (r / CAST(nr AS DOUBLE) + q / CAST(nq AS DOUBLE))) ELSE 0 END) AS js
      FROM s GROUP BY ALL)""".format(parts=" UNION ALL ".join(
    f"SELECT unit_id % 2 AS half, '{name}' AS feature, {sql.format(t='ts')} AS category, CAST(variant IN ('FD001', 'FD003') AS INTEGER) AS r FROM fleet"
    for name, sql in _CATEGORIES.items()))


@query(
    "d1_category_drift",
    f"""WITH {FLEET.replace("user_id % 4", "user_id // 2 % 4")}, {_CATEGORY_COUNTS},
    g AS (SELECT *, (k - 1) / 2e0 AS a, chi / 2 AS x FROM d)
    SELECT CAST(half AS BIGINT) AS half, feature, {as_int("nr")} AS n_reference, {as_int("nq")} AS n_current, {as_int("k")} AS categories,
      {r6("chi")} AS chi_square, {r6("sqrt(greatest(0, js))")} AS jensen_shannon,
      round(greatest(0, least(1, 1 - list_sum(list_transform(range(300), lambda n: exp((a + n) * ln(x) - x - lgamma(a + n + 1)))))), 6) + 0.0 AS p_value,
      1 - list_sum(list_transform(range(300), lambda n: exp((a + n) * ln(x) - x - lgamma(a + n + 1)))) < 0.05 AS drifted FROM g""",
)
def d1_category_drift(spark, sf_dir):
    """Chi-square test and distance of three categorical columns, per half of the units, in one job."""
    df = view.fleet(spark, sf_dir, ("event_type", "ts", "user_id")).df.withColumns({
        "variant": F.concat(F.lit("FD00"), (F.lit(1) + F.floor(F.col("user_id") / 2) % 4).cast("string")),
        "half": (F.col("unit_id") % 2).cast("bigint"),
        "weekday": ((F.dayofweek("ts") - 1)).cast("string"),
        "shift": F.floor(F.hour("ts") / 8).cast("string"),
    })
    split = splits.domain_split(df, [], scale=False)
    out = drift.category_drift(split.train, split.test, list(_CATEGORIES), ["half"], method="chi_square")
    return out.select("half", "feature", "n_reference", "n_current", "categories", *rounded("chi_square", "jensen_shannon", "p_value"), "drifted")


@query(
    "d2_drift_and_quality",
    f"""WITH {GAPS}, {_tall_sql("gaps")}, {_DRIFT}, {_FLAT}, {_SPIKE}
    SELECT 'drifted_features' AS check_name, {as_int("count(*) FILTER (w >= 0.01)")} AS n FROM dist
    UNION ALL SELECT 'flatline', {as_int("count(*)")} FROM flat WHERE variant IN ('FD002', 'FD004')
    UNION ALL SELECT 'missing_spike', {as_int("count(*)")} FROM spike WHERE variant IN ('FD002', 'FD004')""",
)
def d2_drift_and_quality(spark, sf_dir):
    """Drift between the two sides and quality of the unscaled test side."""
    fleet = view.gaps(spark, sf_dir)
    split = splits.domain_split(fleet.df, [], scale=False)
    report = drift.drift_report(
        split.train, split.test, _DRIFT_COLUMNS, method="wasserstein", distance=0.01
    )
    drifted = drift.drift_summary(report).select(
        F.lit("drifted_features").alias("check_name"), F.col("drifted_features").alias("n")
    )
    totals = quality.alert_totals(quality.quality_alerts(split.test, _SENSORS, hot=fleet.hot, dense=True))
    counted = totals.unpivot(
        [], ["flatline_alerts", "missing_spike_alerts"], "check_name", "n"
    ).withColumn("check_name", F.regexp_replace("check_name", "_alerts$", ""))
    return drifted.unionByName(counted)


# --- corruption ------------------------------------------------------------------------------


def _draw_sql(column: str, stream: int) -> str:
    number = sum(ord(ch) * 131**i for i, ch in enumerate(column)) % 2147483647
    return uniform_sql(42, text_key_sql("variant"), "unit_id", "cycle", str(number), str(stream))


@query(
    "r1_inject_missing",
    f"""WITH {FLEET} SELECT variant, unit_id, cycle, CASE WHEN {_draw_sql("sensor_1", 0)} >= 0.2 THEN sensor_1 END AS sensor_1,
    sensor_2 FROM fleet""",
)
def r1_inject_missing(spark, sf_dir):
    out = corrupt.inject_missing(view.fleet(spark, sf_dir).df, ["sensor_1", "absent"], 0.2)
    return out.select(*KEYS, "cycle", "sensor_1", "sensor_2")


@query(
    "r2_inject_noise",
    f"""WITH {FLEET}, s AS (SELECT stddev_pop(sensor_1) / pow(10, 10 / 20e0) AS noise FROM fleet)
    SELECT variant, unit_id, cycle, round(sensor_1 + noise * sqrt(-2 * ln(greatest({_draw_sql("sensor_1", 1)}, 1 / 2147483647e0)))
      * cos(2 * pi() * {_draw_sql("sensor_1", 2)}), 5) + 0.0 AS sensor_1 FROM fleet, s""",
)
def r2_inject_noise(spark, sf_dir):
    out = corrupt.inject_noise(view.fleet(spark, sf_dir).df, ["sensor_1"], 10.0)
    return out.select(*KEYS, "cycle", F.round("sensor_1", 5).alias("sensor_1"))


_START = (((42 * 69621 + 48271) % 2147483647) ** 2 + 1013904223) % 2147483647


@query(
    "r3_inject_flatline",
    f"""WITH {FLEET}, i AS (SELECT *, row_number() OVER (ORDER BY variant, unit_id, cycle) - 1 AS r, count(*) OVER () AS n FROM fleet),
    b AS (SELECT *, greatest(1, CAST(floor(n * 0.2e0) AS BIGINT)) AS len FROM i),
    s AS (SELECT *, {_START} % greatest(1, n - len + 1) AS st FROM b)
    SELECT variant, unit_id, cycle, CASE WHEN r BETWEEN st AND least(st + len, n) - 1
      THEN max(CASE WHEN r = st THEN sensor_1 END) OVER () ELSE sensor_1 END AS sensor_1 FROM s""",
)
def r3_inject_flatline(spark, sf_dir):
    fleet = view.fleet(spark, sf_dir)
    out = corrupt.inject_flatline(fleet.df, ["sensor_1"], 0.2, hot=fleet.hot)
    return out.select(*KEYS, "cycle", "sensor_1")


_NOISE = f"""sqrt(-2 * ln(greatest({_draw_sql("sensor_2", 1)}, 1 / 2147483647e0)))
      * cos(2 * pi() * {_draw_sql("sensor_2", 2)})"""


@query(
    "r4_stress_report",
    f"""WITH {SCORED}, lv AS (SELECT stddev_pop(sensor_2) / pow(10, 10 / 20e0) AS noise FROM scored),
    i AS (SELECT *, row_number() OVER (ORDER BY variant, unit_id, cycle) - 1 AS r, count(*) OVER () AS n FROM scored),
    le AS (SELECT *, greatest(1, CAST(floor(n * 0.2e0) AS BIGINT)) AS len FROM i),
    st AS (SELECT *, {_START} % greatest(1, n - len + 1) AS st FROM le),
    c AS (SELECT 'clean' AS corruption, sensor_2 AS x, label_within_x FROM scored
      UNION ALL SELECT 'missing', CASE WHEN {_draw_sql("sensor_2", 0)} >= 0.2 THEN sensor_2 END, label_within_x FROM scored
      UNION ALL SELECT 'noise', sensor_2 + noise * {_NOISE}, label_within_x FROM scored, lv
      UNION ALL SELECT 'flatline', CASE WHEN r BETWEEN st AND least(st + len, n) - 1
        THEN max(CASE WHEN r = st THEN sensor_2 END) OVER () ELSE sensor_2 END, label_within_x FROM st),
    stressed AS (SELECT corruption, label_within_x, greatest(0e0, least(1e0, coalesce(x, 0) / 100e0)) AS risk FROM c),
    {CURVE.format(g="corruption", t="stressed")},
    rk AS (SELECT corruption, sum(step * prec) AS ap, coalesce(max(rec) FILTER (prec >= 0.8), 0) AS r80 FROM pr GROUP BY 1),
    b AS (SELECT corruption, {bin_sql("risk")} AS bin, count(*) AS n, avg(label_within_x) AS acc, avg(risk) AS conf
      FROM stressed GROUP BY 1, 2),
    ec AS (SELECT corruption, sum(n * abs(acc - conf)) / sum(n) AS ece FROM b GROUP BY 1),
    th AS (SELECT corruption, avg((risk - label_within_x) * (risk - label_within_x)) AS brier,
      2e0 * sum(CAST(risk >= 0.5 AND label_within_x = 1 AS INTEGER))
        / (sum(CAST(risk >= 0.5 AS INTEGER)) + sum(label_within_x)) AS f1 FROM stressed GROUP BY 1)
    SELECT corruption, {r6("ap")} AS pr_auc, {r6("r80")} AS recall_at_p80, {r6("f1")} AS f1, {r6("brier")} AS brier_score,
      {r6("ece")} AS ece FROM rk JOIN ec USING (corruption) JOIN th USING (corruption)""",
)
def r4_stress_report(spark, sf_dir):
    """Five metrics of one score on clean readings and under three corruptions, in one grouped job."""
    fleet = view.labelled(view.fleet(spark, sf_dir))
    readings = fleet.df.select(*KEYS, "cycle", "sensor_2", "label_within_x")
    out = corrupt.stressed(readings, ["sensor_2"], hot=fleet.hot)
    out = out.withColumn("risk", clip(F.col("sensor_2") / 100.0, 0.0, 1.0))
    found = metrics.classification_metrics(out, ["corruption"])
    return found.select("corruption", *rounded("pr_auc", "recall_at_p80", "f1", "brier_score", "ece"))


# --- run table -------------------------------------------------------------------------------


def daily_runs(spark, sf_dir):
    """One run per event type, variant and day: its scores evaluated on that day's readings.
    Sign-ups stand for the regressor, the other types for classifiers on either track."""
    df = view.scored(spark, sf_dir, ("event_type", "ts")).df
    df = df.withColumn("day", F.to_date("ts").cast("string"))
    flagged, y = F.col("risk") >= 0.5, F.col("label_within_x")
    error = F.col("predicted_rul") - F.col("rul")
    tp = F.sum((flagged & (y == 1)).cast("bigint"))
    evaluated = df.groupBy("event_type", "variant", "day").agg(
        F.min("ts").cast(T.TimestampType()).alias("start_time"),
        F.avg((F.col("risk") - y) * (F.col("risk") - y)).alias("brier"),
        F.coalesce(2.0 * tp / F.nullif(F.sum(flagged.cast("bigint")) + F.sum(y), F.lit(0)), F.lit(0.0)).alias("f1"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
    is_reg = F.col("event_type") == "signup"
    track = F.when(F.col("variant").isin("FD001", "FD003"), "track_a").otherwise("track_b")
    classifier = F.map_from_arrays(
        F.array(F.concat(track, F.lit("_brier_score")), F.concat(track, F.lit("_f1"))),
        F.array("brier", "f1"),
    )
    regressor = F.create_map(F.lit("deploy_mae"), F.col("mae"), F.lit("deploy_rmse"), F.col("rmse"))
    return evaluated.select(
        F.concat_ws("-", "event_type", "variant", "day").alias("run_id"),
        F.when(is_reg, runs.REGRESSOR_PREFIX).otherwise(F.col("event_type")).alias("run_name"),
        "start_time",
        F.create_map(F.lit("variant"), F.col("variant"), F.lit("day"), F.col("day")).alias("params"),
        F.when(is_reg, regressor).otherwise(classifier).alias("metrics"),
    )


_RUNS = SCORED + """, ev AS (SELECT event_type, variant, strftime(ts, '%Y-%m-%d') AS day, min(ts) AS start_time,
    avg((risk - label_within_x) * (risk - label_within_x)) AS brier,
    coalesce(2e0 * sum(CAST(risk >= 0.5 AND label_within_x = 1 AS INTEGER)) /
      nullif(sum(CAST(risk >= 0.5 AS INTEGER)) + sum(label_within_x), 0), 0) AS f1,
    avg(abs(predicted_rul - rul)) AS mae, sqrt(avg((predicted_rul - rul) * (predicted_rul - rul))) AS rmse
    FROM scored GROUP BY 1, 2, 3),
  runs AS (SELECT *, event_type || '-' || variant || '-' || day AS run_id,
    CASE WHEN event_type = 'signup' THEN 'xgboost_rul_regressor' ELSE event_type END AS model,
    variant IN ('FD001', 'FD003') AS is_a FROM ev),
  newest AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY model, variant ORDER BY start_time DESC, run_id DESC) = 1)"""


@query(
    "g1_s7_append_and_scan",
    f"WITH {_RUNS} SELECT model, {as_int('2 * count(*)')} AS n_runs, {as_int('count(DISTINCT run_id)')} AS n_ids FROM runs GROUP BY 1",
)
def g1_s7_append_and_scan(spark, sf_dir):
    """Two appends of the day's runs, then a scan of the table."""
    path = scratch_path(spark, "runs")
    batch = daily_runs(spark, sf_dir)
    for _ in range(2):
        runs.append_runs(batch, path)
    return runs.scan_runs(spark, path).groupBy(F.col("run_name").alias("model")).agg(
        F.count(F.lit(1)).alias("n_runs"), F.countDistinct("run_id").alias("n_ids")
    )


@query(
    "g2_run_comparison",
    f"""WITH {_RUNS} SELECT run_id, model, variant, CASE WHEN is_a AND event_type <> 'signup' THEN round(brier, 9) END AS "A_brier",
    CASE WHEN is_a AND event_type <> 'signup' THEN round(f1, 9) END AS "A_f1",
    CASE WHEN NOT is_a AND event_type <> 'signup' THEN round(brier, 9) END AS "B_brier" FROM runs""",
)
def g2_run_comparison(spark, sf_dir):
    out = runs.comparison(daily_runs(spark, sf_dir))
    return out.select("run_id", "model", "variant", *[F.round(c, 9).alias(c) for c in ("A_brier", "A_f1", "B_brier")])


@query(
    "u5_g3_latest_runs",
    f"WITH {_RUNS} SELECT model, variant, run_id FROM newest",
)
def u5_g3_latest_runs(spark, sf_dir):
    return runs.latest(runs.comparison(daily_runs(spark, sf_dir))).select("model", "variant", "run_id")


@query(
    "g4_regressor_table",
    f"""WITH {_RUNS} SELECT model, variant, {r6("mae")} AS deploy_mae, {r6("rmse")} AS deploy_rmse FROM newest
    WHERE model LIKE 'xgboost_rul_regressor%'""",
)
def g4_regressor_table(spark, sf_dir):
    out = runs.regressor_table(daily_runs(spark, sf_dir))
    return out.select("model", "variant", *rounded("deploy_mae", "deploy_rmse"))


@query(
    "g4_classifier_table",
    f"""WITH {_RUNS} SELECT model, variant, CASE WHEN is_a THEN {r6("f1")} END AS "A_f1",
    CASE WHEN NOT is_a THEN {r6("f1")} END AS "B_f1" FROM newest WHERE model NOT LIKE '%rul_regressor%'""",
)
def g4_classifier_table(spark, sf_dir):
    return runs.classifier_table(daily_runs(spark, sf_dir)).select("model", "variant", *rounded("A_f1", "B_f1"))


@query(
    "g5_y15_best_runs",
    f"""WITH {_RUNS}, c AS (SELECT model, variant, CASE WHEN is_a THEN f1 END AS a, CASE WHEN NOT is_a THEN f1 END AS b,
      CASE WHEN is_a THEN brier END AS ab FROM newest WHERE model NOT LIKE '%rul_regressor%')
    (SELECT 'A_f1' AS metric, model, variant, {r6("a")} AS value FROM c WHERE a IS NOT NULL ORDER BY a DESC, model DESC, variant DESC LIMIT 1)
    UNION ALL (SELECT 'B_f1', model, variant, {r6("b")} FROM c WHERE b IS NOT NULL ORDER BY b DESC, model DESC, variant DESC LIMIT 1)
    UNION ALL (SELECT 'A_brier', model, variant, {r6("ab")} FROM c WHERE ab IS NOT NULL ORDER BY ab DESC, model DESC, variant DESC LIMIT 1)""",
)
def g5_y15_best_runs(spark, sf_dir):
    table = runs.classifier_table(daily_runs(spark, sf_dir))
    out = runs.best_per_metric(table, ["A_f1", "B_f1", "A_brier"])
    return out.select("metric", "model", "variant", *rounded("value"))


@query(
    "g6_runs_above",
    f"WITH {_RUNS} SELECT run_id FROM runs WHERE is_a AND event_type <> 'signup' AND f1 > 0.5",
)
def g6_runs_above(spark, sf_dir):
    return runs.runs_above(daily_runs(spark, sf_dir), "track_a_f1", 0.5).select("run_id")


@query(
    "j5_model_of_run",
    f"""WITH {_RUNS}, m AS (SELECT model, arg_max(run_id, (f1, run_id)) AS source_run FROM runs
      WHERE event_type <> 'signup' GROUP BY 1)
    SELECT m.model, source_run, r.variant, {r6("f1")} AS f1 FROM m JOIN runs r ON m.source_run = r.run_id""",
)
def j5_model_of_run(spark, sf_dir):
    """Registered models point at their source run; the run is looked up by id."""
    table = daily_runs(spark, sf_dir)
    score = F.coalesce(runs.metric("track_a_f1"), runs.metric("track_b_f1"))
    evaluated = table.where(~runs.is_regressor("run_name")).withColumn("f1", score)
    registered = evaluated.groupBy(F.col("run_name").alias("model")).agg(
        F.max_by("run_id", F.struct("f1", "run_id")).alias("source_run")
    )
    found = registered.join(evaluated, F.col("source_run") == F.col("run_id"))
    return found.select("model", "source_run", F.col("params")["variant"].alias("variant"), *rounded("f1"))


@query(
    "u2_metric_union",
    f"""WITH {SCORED} SELECT 'A' AS track, {r6("avg(abs(predicted_rul - rul))")} AS mae FROM scored WHERE variant IN ('FD001', 'FD003')
    UNION ALL SELECT 'B', {r6("avg(abs(predicted_rul - rul))")} FROM scored WHERE variant IN ('FD002', 'FD004')""",
)
def u2_metric_union(spark, sf_dir):
    split = splits.domain_split(view.scored(spark, sf_dir).df, [], scale=False)
    tagged = [
        metrics.regression_metrics(side, []).withColumn("track", F.lit(track))
        for track, side in (("A", split.train), ("B", split.test))
    ]
    return tagged[0].unionByName(tagged[1]).select("track", *rounded("mae"))
