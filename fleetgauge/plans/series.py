"""Queries over readings: sources, validation, projections, joins, labels, windows, splits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetgauge.functions.ordering import quantiles
from fleetgauge.functions.scalars import clip
from fleetgauge.operators import features as feat
from fleetgauge.operators import custom, labels, rules, sketches, splits, stats
from fleetgauge.operators.metrics import truth_errors
from fleetgauge.plans import bindings as view
from fleetgauge.plans.registry import (
    FLEET, GAPS, LABELLED, SCORED, WIDE, as_int, hash_sql, query, r6,
)
from fleetgauge.schema import KEYS
from fleetgauge.session import scratch_path
from fleetgauge.sources import tables


def rounded(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


# --- sources and sinks -----------------------------------------------------------------------


@query(
    "s1_text_readings",
    f"WITH {FLEET} SELECT variant, unit_id, cycle, {r6('sensor_1')} AS sensor_1, sensor_2 FROM fleet",
)
def s1_text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fleet as whitespace-separated files per variant and parse them back."""
    df = view.fleet(spark, sf_dir).df
    path = scratch_path(spark, "readings")
    tables.write_text_readings(df, path, ["sensor_1", "sensor_2"], pad=True)
    parsed = tables.read_text_readings(spark, path, ["unit_id", "cycle", "sensor_1", "sensor_2"])
    return parsed.select("variant", "unit_id", "cycle", *rounded("sensor_1"), "sensor_2")


@query(
    "s3_truth_vector",
    f"""WITH {FLEET}, ends AS (SELECT variant, unit_id, max(cycle) AS life FROM fleet GROUP BY 1, 2)
    SELECT variant, CAST(row_number() OVER (PARTITION BY variant ORDER BY unit_id) AS BIGINT) AS unit_id,
           CAST(life AS DOUBLE) AS true_rul FROM ends""",
)
def s3_truth_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one life per line, in unit order, and read the lines back by position."""
    lives = stats.lifetimes(view.fleet(spark, sf_dir).df)
    path = scratch_path(spark, "truth")
    tables.write_truth(lives.withColumnRenamed("lifetime", "true_rul"), path)
    return tables.read_truth(spark, path)


@query(
    "s5_csv_batch_score",
    f"""WITH {FLEET} SELECT variant, unit_id, cycle, sensor_2,
    {r6("sensor_2 / 100")} AS risk_score, sensor_2 / 100 >= 0.5 AS replace_within_30,
    {r6("(1 - sensor_2 / 100) * 340")} AS estimated_rul FROM fleet""",
)
def s5_csv_batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in, scoring columns added, other columns passed through, parquet out."""
    source, target = scratch_path(spark, "batch-in"), scratch_path(spark, "batch-out")
    df = view.fleet(spark, sf_dir).df.select(*KEYS, "cycle", "sensor_2")
    df.write.csv(source, header=True)
    batch = tables.read_csv(spark, source, df.schema, required=["sensor_2"])
    tables.batch_score(batch, F.col("sensor_2") / 100.0, target)
    return spark.read.parquet(target).select(
        *KEYS, "cycle", "sensor_2", *rounded("risk_score"), "replace_within_30", *rounded("estimated_rul")
    )


# --- validation ------------------------------------------------------------------------------


@query(
    "v1_type_coercion",
    """SELECT event_id, 'reading' AS "column", props AS "text" FROM events WHERE event_type = 'error'""",
)
def v1_type_coercion(spark, sf_dir):
    """Readings that arrive as text; what cannot be cast is listed."""
    events = view.table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))
    return rules.coerce(events.select("event_id", text.alias("reading")), {"reading": "double"})[1]


def _strained(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df
    return df.withColumns(
        {"op_setting_1": (F.col("sensor_2") - 50.0) / 45.0, "op_setting_3": F.col("sensor_1")}
    )


_STRAINED = GAPS + """, strained AS (
  SELECT * REPLACE ((sensor_2 - 50) / 45e0 AS op_setting_1), sensor_1 AS op_setting_3 FROM gaps)"""


@query(
    "v2_range_violations",
    f"""WITH {_STRAINED}
    SELECT variant, unit_id, cycle, 'op_setting_1' AS "column", {r6("op_setting_1")} AS value
    FROM strained WHERE op_setting_1 < -1 OR op_setting_1 > 1
    UNION ALL SELECT variant, unit_id, cycle, 'unit_id', unit_id FROM strained WHERE unit_id <= 0
    UNION ALL SELECT variant, unit_id, cycle, 'op_setting_3', {r6("op_setting_3")} FROM strained
      WHERE op_setting_3 < 0 OR op_setting_3 > 100 OR op_setting_3 IS NULL
    UNION ALL SELECT variant, unit_id, cycle, 'sensor_1', sensor_1 FROM strained
      WHERE sensor_1 IS NULL""",
)
def v2_range_violations(spark, sf_dir):
    df = _strained(spark, sf_dir)
    found = rules.violations(df, rules.rules_for(df))
    return found.select(*KEYS, "cycle", "column", *rounded("value"))


@query(
    "v3_duplicate_keys",
    f"SELECT l_orderkey, l_linenumber, {as_int('count(*)')} AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def v3_duplicate_keys(spark, sf_dir):
    return rules.duplicate_keys(view.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "v4_all_missing_rows",
    f"""WITH {GAPS} SELECT variant, unit_id, cycle FROM (SELECT *, CASE WHEN sensor_2 >= 50 THEN sensor_2 END AS s2
    FROM gaps) WHERE coalesce(sensor_1, s2) IS NULL""",
)
def v4_all_missing_rows(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df.withColumn(
        "sensor_2", F.when(F.col("sensor_2") >= 50, F.col("sensor_2"))
    )
    return rules.all_missing_rows(df, ["sensor_1", "sensor_2"]).select(*KEYS, "cycle")


@query(
    "v5_quarantine",
    f"""WITH {_STRAINED}, marked AS (SELECT variant,
      (op_setting_1 BETWEEN -1 AND 1) AND coalesce(op_setting_3 BETWEEN 0 AND 100, false)
      AND unit_id > 0 AND sensor_1 IS NOT NULL AS ok FROM strained)
    SELECT variant, {as_int("count(*) FILTER (ok)")} AS n_good, {as_int("count(*) FILTER (NOT ok)")} AS n_bad
    FROM marked GROUP BY 1""",
)
def v5_quarantine(spark, sf_dir):
    """Lenient mode: good and bad rows separated, all kept."""
    df = _strained(spark, sf_dir)
    good, bad = rules.quarantine(df, rules.rules_for(df))
    sides = good.select("variant", F.lit(1).alias("good")).unionByName(
        bad.select("variant", F.lit(0).alias("good"))
    )
    return sides.groupBy("variant").agg(
        F.sum(F.col("good").cast("bigint")).alias("n_good"),
        F.sum((1 - F.col("good")).cast("bigint")).alias("n_bad"),
    )


@query(
    "v5_violation_report",
    f"""WITH {_STRAINED}
    SELECT * FROM (
    SELECT 'range' AS rule, 'op_setting_1' AS "column", {as_int("count(*)")} AS n
      FROM strained WHERE op_setting_1 < -1 OR op_setting_1 > 1
    UNION ALL SELECT 'range', 'unit_id', {as_int("count(*)")} FROM strained WHERE unit_id <= 0
    UNION ALL SELECT 'range', 'op_setting_3', {as_int("count(*)")} FROM strained
      WHERE op_setting_3 < 0 OR op_setting_3 > 100 OR op_setting_3 IS NULL
    UNION ALL SELECT 'range', 'sensor_1', {as_int("count(*)")} FROM strained WHERE sensor_1 IS NULL
    ) WHERE n > 0""",
)
def v5_violation_report(spark, sf_dir):
    df = _strained(spark, sf_dir)
    return rules.report(df, rules.rules_for(df))


@query(
    "v6_serving_rules",
    f"""WITH {FLEET}, served AS (SELECT variant, unit_id, cycle, 490 + sensor_2 * 2.5 AS s2,
      1150 + sensor_1 * 6 AS s3 FROM fleet)
    SELECT variant, unit_id, cycle, s2 >= 500 AND s2 <= 700 AND s3 >= 1200 AND s3 <= 1700
      AND unit_id >= 1 AND cycle >= 1 AS is_valid FROM served""",
)
def v6_serving_rules(spark, sf_dir):
    df = view.fleet(spark, sf_dir).df.withColumns(
        {"sensor_2": 490.0 + F.col("sensor_2") * 2.5, "sensor_3": 1150.0 + F.col("sensor_1") * 6.0}
    )
    served = rules.rules_for(df, rules.SERVING_RULES)
    return rules.mark_valid(df, served).select(*KEYS, "cycle", "is_valid")


# --- projections, filters, missing values ----------------------------------------------------


@query(
    "p2_zero_fill",
    f"WITH {GAPS} SELECT variant, unit_id, cycle, coalesce(sensor_1, 0) AS sensor_1, sensor_2 FROM gaps",
)
def p2_zero_fill(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df
    return splits.zero_filled(df, ["sensor_1", "sensor_2"]).select(*KEYS, "cycle", "sensor_1", "sensor_2")


@query(
    "p3_median_fill",
    f"""WITH {GAPS} SELECT variant, unit_id, cycle,
    {r6("coalesce(sensor_1, (SELECT quantile_cont(sensor_1, 0.5) FROM gaps))")} AS sensor_1 FROM gaps""",
)
def p3_median_fill(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df
    median = quantiles(df, [], "sensor_1", {"median": 0.5}).select("median").scalar()
    return df.select(*KEYS, "cycle", F.round(F.coalesce("sensor_1", median), 6).alias("sensor_1"))


@query(
    "p4_drop_missing",
    f"WITH {GAPS} SELECT variant, unit_id, cycle, sensor_1 FROM gaps WHERE sensor_1 IS NOT NULL",
)
def p4_drop_missing(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df.select(*KEYS, "cycle", "sensor_1")
    return df.dropna(subset=["sensor_1", "cycle"])


@query(
    "p5_clip",
    f"""WITH {GAPS} SELECT variant, unit_id, cycle, CASE WHEN sensor_1 IS NOT NULL THEN
    greatest(10, least(100, sensor_1)) END AS clipped FROM gaps""",
)
def p5_clip(spark, sf_dir):
    df = view.gaps(spark, sf_dir).df
    return df.select(*KEYS, "cycle", clip(F.col("sensor_1"), 10.0, 100.0).alias("clipped"))


@query(
    "p6_float32",
    f"WITH {FLEET} SELECT unit_id, cycle, CAST(sensor_1 AS FLOAT) AS sensor_1 FROM fleet",
)
def p6_float32(spark, sf_dir):
    df = view.fleet(spark, sf_dir).df
    return df.select("unit_id", "cycle", F.col("sensor_1").cast("float").alias("sensor_1"))


@query(
    "p7_positive_rows",
    f"WITH {LABELLED} SELECT variant, unit_id, cycle, rul FROM labelled WHERE label_within_x = 1",
)
def p7_positive_rows(spark, sf_dir):
    df = view.labelled(view.fleet(spark, sf_dir)).df
    return df.where("label_within_x = 1").select(*KEYS, "cycle", "rul")


@query(
    "p8_literal_variant",
    "SELECT CAST(doc_id AS BIGINT) AS doc_id, 'FD009' AS variant, quality FROM labels",
)
def p8_literal_variant(spark, sf_dir):
    return view.table(spark, sf_dir, "labels").select(
        "doc_id", F.lit("FD009").alias("variant"), "quality"
    )


# --- joins and set operations ----------------------------------------------------------------


_BUSY = """busy AS (SELECT DISTINCT variant, unit_id FROM fleet WHERE sensor_1 > 200)"""


@query(
    "j1_unit_membership",
    f"""WITH {FLEET}, {_BUSY} SELECT f.variant, f.unit_id, f.cycle, b.unit_id IS NOT NULL AS is_busy
    FROM fleet f LEFT JOIN busy b ON f.variant = b.variant AND f.unit_id = b.unit_id""",
)
def j1_unit_membership(spark, sf_dir):
    """Rows of a unit set and of its complement, by semi and anti join."""
    df = view.fleet(spark, sf_dir).df
    busy = df.where("sensor_1 > 200").select(*KEYS).distinct()
    inside = df.join(busy, KEYS, "left_semi").withColumn("is_busy", F.lit(True))
    outside = df.join(busy, KEYS, "left_anti").withColumn("is_busy", F.lit(False))
    return inside.unionByName(outside).select(*KEYS, "cycle", "is_busy")


@query(
    "j2_truth_alignment",
    f"""WITH {SCORED}, last AS (SELECT variant, unit_id, arg_max(predicted_rul, cycle) AS predicted_rul
      FROM scored GROUP BY 1, 2),
    truth AS (SELECT DISTINCT variant, unit_id, CAST(unit_id % 40 AS DOUBLE) AS true_rul FROM fleet)
    SELECT l.variant, l.unit_id, {r6("predicted_rul")} AS predicted_rul, true_rul FROM last l
    JOIN truth t ON l.variant = t.variant AND l.unit_id = t.unit_id""",
)
def j2_truth_alignment(spark, sf_dir):
    df = view.scored(spark, sf_dir).df
    return feat.last_rows(df).join(_truth(df), KEYS).select(*KEYS, *rounded("predicted_rul"), "true_rul")


def _truth(df: DataFrame) -> DataFrame:
    units = df.select(*KEYS).distinct()
    return units.withColumn("true_rul", (F.col("unit_id") % 40).cast("double"))


@query(
    "j3_unit_maximum",
    f"""WITH {FLEET} SELECT variant, unit_id, cycle,
    max(sensor_1) OVER (PARTITION BY variant, unit_id) AS unit_max FROM fleet""",
)
def j3_unit_maximum(spark, sf_dir):
    fleet = view.fleet(spark, sf_dir)
    out = labels.per_unit(fleet.df, fleet.hot, unit_max=F.max("sensor_1"))
    return out.select(*KEYS, "cycle", "unit_max")


@query(
    "j4_scaler_applied",
    f"""WITH {FLEET}, s AS (SELECT avg(sensor_1) AS m, stddev_pop(sensor_1) AS d FROM fleet
      WHERE variant IN ('FD001', 'FD003'))
    SELECT variant, unit_id, cycle, {r6("(sensor_1 - m) / d")} AS sensor_1 FROM fleet, s
    WHERE variant IN ('FD002', 'FD004')""",
)
def j4_scaler_applied(spark, sf_dir):
    split = splits.domain_split(view.fleet(spark, sf_dir).df, ["sensor_1"])
    return split.test.select(*KEYS, "cycle", *rounded("sensor_1"))


@query(
    "u1_union_variants",
    f"""WITH {FLEET}, {WIDE}
    SELECT variant, unit_id, cycle, sensor_1 FROM fleet
    UNION ALL SELECT variant, unit_id, cycle, sensor_1 FROM wide""",
)
def u1_union_variants(spark, sf_dir):
    columns = [*KEYS, "cycle", "sensor_1"]
    return view.fleet(spark, sf_dir).df.select(*columns).unionByName(
        view.wide(spark, sf_dir).df.select(*columns)
    )


_SIDES = f"""sides AS (
  SELECT variant, unit_id, row_number() OVER (PARTITION BY variant ORDER BY h, unit_id)
         <= floor(count(*) OVER (PARTITION BY variant) * 0.8e0) AS is_train
  FROM (SELECT DISTINCT variant, unit_id, {hash_sql(42, "unit_id")} AS h FROM fleet))"""


@query(
    "u3_leakage_check",
    f"""WITH {FLEET}, {_SIDES} SELECT {as_int("count(*)")} AS n_shared FROM
    (SELECT variant, unit_id FROM sides WHERE is_train INTERSECT
     SELECT variant, unit_id FROM sides WHERE NOT is_train)""",
)
def u3_leakage_check(spark, sf_dir):
    split = splits.holdout_split(view.fleet(spark, sf_dir).df, [], scale=False)
    shared = splits.shared_units(split.train, split.test)
    return shared.agg(F.count(F.lit(1)).alias("n_shared"))


@query(
    "u6_distinct_units",
    f"WITH {WIDE} SELECT DISTINCT variant, unit_id FROM wide",
)
def u6_distinct_units(spark, sf_dir):
    return splits.units_of(view.wide(spark, sf_dir).df)


# --- labels ----------------------------------------------------------------------------------


@query("l1_rul", f"WITH {LABELLED} SELECT variant, unit_id, cycle, rul FROM labelled")
def l1_rul(spark, sf_dir):
    fleet = view.fleet(spark, sf_dir)
    return labels.add_rul(fleet.df, fleet.hot).select(*KEYS, "cycle", "rul")


@query("l2_binary_label", f"WITH {LABELLED} SELECT variant, unit_id, cycle, label_within_x FROM labelled")
def l2_binary_label(spark, sf_dir):
    return view.labelled(view.fleet(spark, sf_dir)).df.select(*KEYS, "cycle", "label_within_x")


@query(
    "l3_truncated_labels",
    f"""WITH {FLEET} SELECT variant, unit_id, cycle,
    CAST(unit_id % 40 + max(cycle) OVER (PARTITION BY variant, unit_id) - cycle AS INTEGER) AS rul
    FROM fleet""",
)
def l3_truncated_labels(spark, sf_dir):
    fleet = view.fleet(spark, sf_dir)
    out = labels.add_rul_from_truth(fleet.df, _truth(fleet.df), fleet.hot)
    return out.select(*KEYS, "cycle", "rul")


@query(
    "l4_capped_rul",
    f"""WITH {WIDE}, ends AS (SELECT *, max(cycle) OVER (PARTITION BY variant, unit_id) - cycle AS rul FROM wide)
    SELECT variant, unit_id, cycle, least(CAST(rul AS DOUBLE), 125) AS rul_capped FROM ends""",
)
def l4_capped_rul(spark, sf_dir):
    wide = view.wide(spark, sf_dir)
    out = labels.add_rul(wide.df, wide.hot)
    return out.select(*KEYS, "cycle", labels.capped("rul").alias("rul_capped"))


# --- window features -------------------------------------------------------------------------


def frame_sql(sensor: str, window: int) -> tuple[str, str, str]:
    """Rolling mean, deviation and slope of the oracle."""
    over = f"(PARTITION BY variant, unit_id ORDER BY cycle ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    least = max(1, window // 2)
    enough = f"count({sensor}) OVER {over} >= {least}"
    whole = f"count({sensor}) OVER {over} = count(*) OVER {over}"
    slope = f"regr_slope({sensor}, CAST(cycle AS DOUBLE)) OVER {over}"
    pairs = f"count({sensor}) OVER {over} > 1"
    return (
        f"CASE WHEN {enough} THEN {r6(f'avg({sensor}) OVER {over}')} END",
        f"CASE WHEN {enough} AND {pairs} THEN {r6(f'stddev_samp({sensor}) OVER {over}')} END",
        f"CASE WHEN {enough} AND {whole} AND {pairs} THEN {r6(slope)} END",
    )


def _rolling_query(kind: int, label: str):
    columns = ", ".join(f"{frame_sql('sensor_1', w)[kind]} AS sensor_1_{label}_w{w}" for w in (10, 20, 30))
    sql = f"WITH {GAPS} SELECT variant, unit_id, cycle, {columns} FROM gaps"

    def run(spark, sf_dir):
        fleet = view.gaps(spark, sf_dir)
        out = feat.add_features(fleet.df, ["sensor_1"], lags=[], hot=fleet.hot, dense=True)
        return out.select(*KEYS, "cycle", *rounded(*[f"sensor_1_{label}_w{w}" for w in (10, 20, 30)]))

    query(f"w{kind + 1}_rolling_{label}", sql)(run)


for _kind, _label in enumerate(("mean", "std", "slope")):
    _rolling_query(_kind, _label)


_LAG = "lag(sensor_1, {k}) OVER (PARTITION BY variant, unit_id ORDER BY cycle) AS sensor_1_lag{k}"


@query(
    "w4_lags",
    f"""WITH {GAPS} SELECT variant, unit_id, cycle, {", ".join(_LAG.format(k=k) for k in (1, 3, 5))} FROM gaps""",
)
def w4_lags(spark, sf_dir):
    fleet = view.gaps(spark, sf_dir)
    out = feat.add_features(fleet.df, ["sensor_1"], windows=[], hot=fleet.hot, dense=True)
    return out.select(*KEYS, "cycle", "sensor_1_lag1", "sensor_1_lag3", "sensor_1_lag5")


def _all_features_sql() -> str:
    parts = []
    for s in view.WIDE_SENSORS:
        for w in (10, 20, 30):
            mean, std, slope = frame_sql(s, w)
            for kind, text in (("mean", mean), ("std", std), ("slope", slope)):
                exact = text.replace("round(", "round_even(1e6 * ").replace(", 6) + 0.0", ", 0) / 1e6 + 0.0")
                parts.append(f"{exact} AS {s}_{kind}_w{w}")
        parts += [
            f"lag({s}, {k}) OVER (PARTITION BY variant, unit_id ORDER BY cycle) AS {s}_lag{k}" for k in (1, 3, 5)
        ]
    return f"WITH {WIDE} SELECT variant, unit_id, cycle, {', '.join(parts)} FROM wide"


@query("w5_feature_transformer", _all_features_sql())
def w5_feature_transformer(spark, sf_dir):
    """The pipeline stage over all sensors, windows and lags."""
    stage = feat.RollingLagTransformer(sensors=view.WIDE_SENSORS, dense=True)
    out = stage.transform(view.wide(spark, sf_dir).df)
    derived = [c for c in out.columns if "_w" in c or "_lag" in c]
    return out.select(*KEYS, "cycle", *[
        F.col(c) if "_lag" in c else (F.rint(F.lit(1e6) * F.col(c)) / 1e6 + 0.0).alias(c)
        for c in derived
    ])


@query(
    "w5_long_features",
    f"""WITH {GAPS}, tall AS (SELECT variant, unit_id, cycle, 'sensor_1' AS sensor, sensor_1 AS value FROM gaps
      UNION ALL SELECT variant, unit_id, cycle, 'sensor_2', sensor_2 FROM gaps
      UNION ALL SELECT variant, unit_id, cycle, 'sensor_3', sensor_3 FROM gaps)
    SELECT variant, unit_id, cycle, sensor,
    {", ".join(c.replace("PARTITION BY variant, unit_id", "PARTITION BY variant, unit_id, sensor") + f" AS {n}_w10"
               for c, n in zip(frame_sql("value", 10), ("mean", "std", "slope")))},
    lag(value, 1) OVER (PARTITION BY variant, unit_id, sensor ORDER BY cycle) AS lag1 FROM tall""",
)
def w5_long_features(spark, sf_dir):
    """One row per reading and sensor: the layout for many sensors."""
    fleet = view.gaps(spark, sf_dir)
    out = feat.long_features(fleet.df, view.FLEET_SENSORS, windows=[10], lags=[1], hot=fleet.hot, dense=True)
    return out.select(*KEYS, "cycle", "sensor", *rounded("mean_w10", "std_w10", "slope_w10"), "lag1")


def _median(held):
    return np.nanmedian(held, axis=1)


def _spread(held):
    return np.nanmax(held, axis=1) - np.nanmin(held, axis=1)


_W20 = "PARTITION BY variant, unit_id ORDER BY cycle ROWS BETWEEN 19 PRECEDING AND CURRENT ROW"


@query(
    "w9_own_rolling_function",
    f"""WITH {GAPS} SELECT variant, unit_id, cycle,
    CASE WHEN count(sensor_1) OVER w >= 10 THEN {r6("quantile_cont(sensor_1, 0.5) OVER w")} END AS sensor_1_median_w20,
    CASE WHEN count(sensor_1) OVER w >= 10 THEN {r6("max(sensor_1) OVER w - min(sensor_1) OVER w")} END AS sensor_1_range_w20
    FROM gaps WINDOW w AS ({_W20})""",
)
def w9_own_rolling_function(spark, sf_dir):
    """A user's median and range over 20 readings, with values missing."""
    fleet = view.gaps(spark, sf_dir)
    out = custom.add_rolling(
        fleet.df, {"median": _median, "range": _spread}, 20, ["sensor_1"], hot=fleet.hot, dense=True
    )
    return out.select(*KEYS, "cycle", *rounded("sensor_1_median_w20", "sensor_1_range_w20"))


@query(
    "w6_sequences",
    f"""WITH {LABELLED}, seq AS (SELECT variant, unit_id, cycle, label_within_x,
      list(CAST(sensor_2 AS FLOAT)) OVER w AS xs, count(*) OVER w AS n FROM labelled
      WINDOW w AS (PARTITION BY variant, unit_id ORDER BY cycle ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
    SELECT variant, unit_id, cycle, label_within_x, {as_int("n")} AS n_steps, xs[1] AS first_step,
      {r6("list_sum(xs)")} AS total FROM seq WHERE n = 30""",
)
def w6_sequences(spark, sf_dir):
    fleet = view.labelled(view.fleet(spark, sf_dir))
    out = feat.add_sequences(fleet.df, ["sensor_2"], 30, hot=fleet.hot, dense=True)
    total = F.aggregate("sequence", F.lit(0.0), lambda acc, step: acc + step[0])
    return out.select(
        *KEYS, "cycle", "label_within_x", F.size("sequence").cast("bigint").alias("n_steps"),
        F.col("sequence")[0][0].alias("first_step"), F.round(total, 6).alias("total"),
    )


@query(
    "w7_last_rows",
    f"""WITH {WIDE} SELECT variant, unit_id, cycle, sensor_1, sensor_2 FROM wide
    QUALIFY row_number() OVER (PARTITION BY variant, unit_id ORDER BY cycle DESC) = 1""",
)
def w7_last_rows(spark, sf_dir):
    return feat.last_rows(view.wide(spark, sf_dir).df).select(*KEYS, "cycle", "sensor_1", "sensor_2")


@query(
    "w8_running_share",
    f"""WITH {FLEET}, v AS (SELECT variant, sensor_2, count(*) AS n FROM fleet GROUP BY 1, 2)
    SELECT variant, sensor_2, {as_int("n")} AS n,
      {as_int("sum(n) OVER (PARTITION BY variant ORDER BY sensor_2)")} AS n_upto,
      {r6("sum(n) OVER (PARTITION BY variant ORDER BY sensor_2) / CAST(sum(n) OVER (PARTITION BY variant) AS DOUBLE)")} AS share
    FROM v""",
)
def w8_running_share(spark, sf_dir):
    """Running counts and empirical distribution of a sensor, per variant."""
    from fleetgauge.functions.ordering import histogram, running

    hist = histogram(view.fleet(spark, sf_dir).df, ["variant"], "sensor_2")
    out = running(hist, ["variant"], "sensor_2", {"n_upto": "n"}, {"_size": "n_upto"})
    share = F.round(F.col("n_upto") / F.col("_size"), 6).alias("share")
    return out.select("variant", "sensor_2", "n", "n_upto", share)


# --- splits and scaling ----------------------------------------------------------------------


@query("x1_unit_holdout", f"WITH {FLEET}, {_SIDES} SELECT variant, unit_id, is_train FROM sides")
def x1_unit_holdout(spark, sf_dir):
    return splits.assign_units(view.fleet(spark, sf_dir).df)


@query(
    "x1_holdout_scaled",
    f"""WITH {FLEET}, {_SIDES}, s AS (SELECT avg(sensor_1) AS m, stddev_pop(sensor_1) AS d
      FROM fleet SEMI JOIN (SELECT * FROM sides WHERE is_train) t USING (variant, unit_id))
    SELECT variant, unit_id, cycle, {r6("(sensor_1 - m) / d")} AS sensor_1 FROM
    (SELECT f.* FROM fleet f JOIN sides USING (variant, unit_id) WHERE NOT is_train), s""",
)
def x1_holdout_scaled(spark, sf_dir):
    split = splits.holdout_split(view.fleet(spark, sf_dir).df, ["sensor_1"])
    return split.test.select(*KEYS, "cycle", *rounded("sensor_1"))


@query(
    "x2_domain_split",
    f"""WITH {FLEET} SELECT variant, variant IN ('FD001', 'FD003') AS is_train, {as_int("count(*)")} AS n
    FROM fleet GROUP BY 1, 2""",
)
def x2_domain_split(spark, sf_dir):
    split = splits.domain_split(view.fleet(spark, sf_dir).df, [], scale=False)
    both = split.train.withColumn("is_train", F.lit(True)).unionByName(
        split.test.withColumn("is_train", F.lit(False))
    )
    return both.groupBy("variant", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x3_scaler_statistics",
    f"""WITH {GAPS} SELECT {r6("avg(coalesce(sensor_1, 0))")} AS sensor_1_mean,
    {r6("stddev_pop(coalesce(sensor_1, 0))")} AS sensor_1_std, {r6("avg(sensor_2)")} AS sensor_2_mean,
    {r6("stddev_pop(sensor_2)")} AS sensor_2_std FROM gaps""",
)
def x3_scaler_statistics(spark, sf_dir):
    out = splits.scaler_statistics(view.gaps(spark, sf_dir).df, ["sensor_1", "sensor_2"])
    return out.select(*rounded(*out.columns))


@query(
    "x4_validation_units",
    f"""WITH {FLEET}, u AS (SELECT variant, unit_id, min(cycle) AS c FROM fleet GROUP BY 1, 2)
    SELECT variant, unit_id FROM u QUALIFY row_number() OVER (PARTITION BY variant ORDER BY c, unit_id)
      <= greatest(1, floor(count(*) OVER (PARTITION BY variant) * 0.1e0))""",
)
def x4_validation_units(spark, sf_dir):
    return splits.validation_units(view.fleet(spark, sf_dir).df)


@query(
    "x5_stratified_holdout",
    f"""WITH {LABELLED}, h AS (SELECT variant, unit_id, cycle, label_within_x,
      {hash_sql(42, "unit_id", "cycle")} AS h FROM labelled)
    SELECT variant, unit_id, cycle, label_within_x,
      row_number() OVER (PARTITION BY label_within_x ORDER BY h, variant, unit_id, cycle)
      <= round_even(count(*) OVER (PARTITION BY label_within_x) * 0.1e0, 0) AS is_holdout FROM h""",
)
def x5_stratified_holdout(spark, sf_dir):
    df = view.labelled(view.fleet(spark, sf_dir)).df.select(*KEYS, "cycle", "label_within_x")
    return splits.stratified_holdout(df)


# --- exploration -----------------------------------------------------------------------------

_LIVES = "lives AS (SELECT variant, unit_id, max(cycle) AS life, count(*) AS n FROM {t} GROUP BY 1, 2)"


@query(
    "a1_variant_summary",
    f"""WITH {WIDE}, {_LIVES.format(t="wide")} SELECT variant, {as_int("count(*)")} AS n_units,
    {as_int("sum(n)")} AS n_rows, min(life) AS min_cycles, max(life) AS max_cycles,
    quantile_cont(CAST(life AS DOUBLE), 0.5) AS median_cycles FROM lives GROUP BY 1""",
)
def a1_variant_summary(spark, sf_dir):
    return stats.variant_summary(view.wide(spark, sf_dir).df)


@query(
    "a2_lifetime_histogram",
    f"""WITH {FLEET}, {_LIVES.format(t="fleet")}, b AS (SELECT variant, min(life) AS lo, max(life) AS hi,
      (max(life) - min(life)) / 20e0 AS wid FROM lives GROUP BY 1),
    t AS (SELECT lives.variant, lo, wid, CASE WHEN wid > 0 THEN least(19, floor((life - lo) / wid)) ELSE 0 END AS bin
      FROM lives JOIN b USING (variant))
    SELECT variant, CAST(bin AS INTEGER) AS bin, {r6("min(lo + bin * wid)")} AS bin_low, {as_int("count(*)")} AS n
    FROM t GROUP BY 1, 2""",
)
def a2_lifetime_histogram(spark, sf_dir):
    out = stats.binned(stats.lifetimes(view.fleet(spark, sf_dir).df), "lifetime", ["variant"])
    return out.select("variant", "bin", *rounded("bin_low"), "n")


@query(
    "a3_median_unit",
    f"""WITH {WIDE}, {_LIVES.format(t="wide")}, m AS (SELECT variant,
      quantile_cont(CAST(life AS DOUBLE), 0.5) AS med FROM lives GROUP BY 1)
    SELECT variant, unit_id FROM lives JOIN m USING (variant)
    QUALIFY row_number() OVER (PARTITION BY variant ORDER BY abs(life - med), unit_id) = 1""",
)
def a3_median_unit(spark, sf_dir):
    return stats.median_unit(view.wide(spark, sf_dir).df)


_TALL = """tall AS (SELECT 'sensor_1' AS sensor, sensor_1 AS x, rul FROM {t} WHERE sensor_1 IS NOT NULL
  UNION ALL SELECT 'sensor_2', sensor_2, rul FROM {t} UNION ALL SELECT 'sensor_3', sensor_3, rul FROM {t}),
ranked AS (SELECT sensor,
  rank() OVER (PARTITION BY sensor ORDER BY x) + (count(*) OVER (PARTITION BY sensor, x) - 1) / 2e0 AS rx,
  rank() OVER (PARTITION BY sensor ORDER BY rul) + (count(*) OVER (PARTITION BY sensor, rul) - 1) / 2e0 AS ry
  FROM tall),
rho AS (SELECT sensor, count(*) AS n_pairs, corr(rx, ry) AS rho FROM ranked GROUP BY 1)"""

_GAPS_RUL = GAPS + """, gl AS (SELECT *, max(cycle) OVER (PARTITION BY variant, unit_id) - cycle AS rul FROM gaps)"""


@query(
    "a4_spearman",
    f"""WITH {_GAPS_RUL}, {_TALL.format(t="gl")} SELECT sensor, {as_int("n_pairs")} AS n_pairs, {r6("rho")} AS rho FROM rho""",
)
def a4_spearman(spark, sf_dir):
    fleet = view.gaps(spark, sf_dir)
    out = stats.spearman(labels.add_rul(fleet.df, fleet.hot), view.FLEET_SENSORS)
    return out.select("sensor", "n_pairs", *rounded("rho"))


@query(
    "a5_best_sensor",
    f"""WITH {_GAPS_RUL}, {_TALL.format(t="gl")} SELECT sensor, {r6("rho")} AS rho FROM rho
    ORDER BY abs(rho) DESC LIMIT 1""",
)
def a5_best_sensor(spark, sf_dir):
    fleet = view.gaps(spark, sf_dir)
    rho = stats.spearman(labels.add_rul(fleet.df, fleet.hot), view.FLEET_SENSORS)
    return stats.best_sensor(rho, view.FLEET_SENSORS).select("sensor", *rounded("rho"))


@query(
    "a6_class_balance",
    f"""WITH {LABELLED} SELECT variant, {as_int("count(*)")} AS n_rows, {as_int("sum(label_within_x)")} AS n_positive,
    {r6("avg(label_within_x)")} AS positive_rate FROM labelled GROUP BY 1""",
)
def a6_class_balance(spark, sf_dir):
    out = stats.class_balance(view.labelled(view.fleet(spark, sf_dir)).df)
    return out.select("variant", "n_rows", "n_positive", *rounded("positive_rate"))


@query("a7_operating_regimes")
def a7_operating_regimes(spark, sf_dir):
    """k-means bins of two settings; counts per variant and regime."""
    df = view.wide(spark, sf_dir).df.withColumns(
        {"op_setting_1": F.col("sensor_1"), "op_setting_2": F.col("sensor_3")}
    )
    return stats.regimes(df).groupBy("variant", "op_regime").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a8_missing_rates",
    f"""WITH {GAPS} SELECT 'sensor_1' AS feature, {r6("avg(CAST(sensor_1 IS NULL AS INTEGER))")} AS missing_rate FROM gaps
    UNION ALL SELECT 'sensor_2', {r6("avg(CAST(sensor_2 IS NULL AS INTEGER))")} FROM gaps
    UNION ALL SELECT 'sensor_3', {r6("avg(CAST(sensor_3 IS NULL AS INTEGER))")} FROM gaps""",
)
def a8_missing_rates(spark, sf_dir):
    out = stats.missing_rates(view.gaps(spark, sf_dir).df, view.FLEET_SENSORS)
    return out.select("feature", *rounded("missing_rate"))


@query(
    "a9_scaling_effect",
    f"""WITH {FLEET}, s AS (SELECT avg(sensor_1) AS m, stddev_pop(sensor_1) AS d FROM fleet
      WHERE variant IN ('FD001', 'FD003')),
    z AS (SELECT sensor_1, (sensor_1 - m) / d AS z FROM fleet, s WHERE variant IN ('FD002', 'FD004'))
    SELECT 'raw' AS stage, {r6("avg(sensor_1)")} AS mean, {r6("stddev_samp(sensor_1)")} AS std_samp FROM z
    UNION ALL SELECT 'scaled', {r6("avg(z)")}, {r6("stddev_samp(z)")} FROM z""",
)
def a9_scaling_effect(spark, sf_dir):
    """Test-side mean and deviation before and after train-fitted scaling."""
    df = view.fleet(spark, sf_dir).df
    raw = splits.domain_split(df, ["sensor_1"], scale=False).test
    scaled = splits.domain_split(df, ["sensor_1"]).test
    both = stats.moments(raw, ["sensor_1"]).withColumn("stage", F.lit("raw")).unionByName(
        stats.moments(scaled, ["sensor_1"]).withColumn("stage", F.lit("scaled"))
    )
    return both.select("stage", *rounded("mean", "std_samp"))


@query(
    "a10_varying_features",
    f"""WITH {WIDE}, v AS (SELECT 'sensor_1' AS feature, var_samp(sensor_1) AS v FROM wide
      UNION ALL SELECT 'sensor_2', var_samp(sensor_2) FROM wide
      UNION ALL SELECT 'sensor_3', var_samp(sensor_3) FROM wide
      UNION ALL SELECT 'sensor_4', var_samp(sensor_4) FROM wide)
    SELECT feature, round(v, 3) AS variance FROM v WHERE v >= 1e-8 ORDER BY v DESC LIMIT 3""",
)
def a10_varying_features(spark, sf_dir):
    out = stats.varying_features(view.wide(spark, sf_dir).df, view.WIDE_SENSORS, top=3)
    return out.select("feature", F.round("variance", 3).alias("variance"))


@query(
    "a11_quantiles",
    f"""WITH {WIDE} SELECT variant, {as_int("count(*)")} AS n, {r6("quantile_cont(sensor_2, 0.1)")} AS q10,
    {r6("quantile_cont(sensor_2, 0.5)")} AS q50, {r6("quantile_cont(sensor_2, 0.9)")} AS q90 FROM wide GROUP BY 1""",
)
def a11_quantiles(spark, sf_dir):
    out = quantiles(view.wide(spark, sf_dir).df, ["variant"], "sensor_2", {"q10": 0.1, "q50": 0.5, "q90": 0.9})
    return out.select("variant", "n", *rounded("q10", "q50", "q90"))


@query(
    "a11_a12_stored_sketches",
    f"""WITH {FLEET} SELECT variant, {as_int("count(*)")} AS n_rows, {as_int("count(DISTINCT CAST(ts AS DATE))")} AS n_days,
    count(*) > 0 AS ranks_near, count(DISTINCT unit_id) > 0 AS members_near FROM fleet GROUP BY 1""",
)
def a11_a12_stored_sketches(spark, sf_dir):
    """Quantiles and units per variant from sketches stored by day in two appends, no row read again; the
    answers' ranks are within 3 % and the counts within 5 % of the exact ones."""
    df = view.fleet(spark, sf_dir, ("ts",)).df.withColumn("day", F.to_date("ts")).drop("ts")
    path, levels = scratch_path(spark, "sketches"), {"q10": 0.1, "q50": 0.5, "q90": 0.9}
    for half in (0, 1):
        part = df.where(F.dayofmonth("day") % 2 == half)
        sketches.append_sketches(sketches.sketched(part, ["variant", "day"], "sensor_1", "unit_id"), path, "day")
    stored = sketches.read_sketches(spark, path)
    found = sketches.answers(sketches.merged(stored, ["variant"]), levels)
    days = stored.groupBy("variant").agg(F.countDistinct("day").alias("n_days"))
    exact = df.groupBy("variant").agg(F.countDistinct("unit_id").alias("_units"))
    errors = sketches.rank_errors(found, df, ["variant"], "sensor_1", levels)
    joined = found.join(days, "variant").join(exact, "variant").join(errors, "variant")
    near = F.abs(F.col("n_members") - F.col("_units")) <= F.col("_units") * 0.05
    return joined.select("variant", "n_rows", "n_days", (F.col("rank_error") <= 0.03).alias("ranks_near"), near.alias("members_near"))


@query(
    "a12_counts",
    f"""WITH {WIDE} SELECT variant, {as_int("count(*)")} AS n_rows, {as_int("count(DISTINCT unit_id)")} AS n_units
    FROM wide GROUP BY 1""",
)
def a12_counts(spark, sf_dir):
    return view.wide(spark, sf_dir).df.groupBy("variant").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("unit_id").alias("n_units")
    )


@query(
    "m15_truth_errors",
    f"""WITH {SCORED}, last AS (SELECT variant, unit_id, arg_max(predicted_rul, cycle) AS p,
      CAST(unit_id % 40 AS DOUBLE) AS t FROM scored GROUP BY variant, unit_id),
    c AS (SELECT *, greatest(0, least(125, p)) AS pc, greatest(0, least(125, t)) AS tc FROM last)
    SELECT {as_int("count(*)")} AS n_units, {r6("avg(abs(p - t))")} AS mae, {r6("sqrt(avg((p - t) * (p - t)))")} AS rmse,
    {r6("avg(abs(pc - tc))")} AS mae_capped, {r6("sqrt(avg((pc - tc) * (pc - tc)))")} AS rmse_capped FROM c""",
)
def m15_truth_errors(spark, sf_dir):
    df = view.scored(spark, sf_dir).df
    out = truth_errors(feat.last_rows(df), _truth(df), KEYS)
    return out.select("n_units", *rounded("mae", "rmse", "mae_capped", "rmse_capped"))
