"""Queries that fit models, and the streaming jobs."""

from __future__ import annotations

import datetime as dt
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from fleetgauge.operators import features as feat
from fleetgauge.functions.scalars import key_uniform, text_key
from fleetgauge.operators import (
    baseline, leaves, metrics, models, passes, permutation, policy, runs, splits, survival, uncertainty,
)
from fleetgauge.plans import bindings as view
from fleetgauge.plans.registry import (
    FLEET, GAPS, LABELLED, as_int, hash_sql, query, r6, text_key_sql, uniform_sql,
)
from fleetgauge.operators.rules import SERVING_RANGES, SERVING_RULES, rules_for
from fleetgauge.schema import KEYS, SENSORS, feature_columns
from fleetgauge.session import evenly, pinned, scratch_path
from fleetgauge.streaming import jobs


def rounded(*columns: str) -> list:
    return [F.round(F.col(c), 6).alias(c) for c in columns]


def _learning_split(spark, sf_dir) -> tuple[splits.Split, list[str]]:
    """Held-out units over all sensors, windows and lags, and the names of the features."""
    fleet = view.labelled(view.fleet(spark, sf_dir))
    df = feat.add_features(fleet.df, hot=fleet.hot, dense=True).withColumn("cycle_age", F.col("cycle").cast("double"))
    kept = pinned(df)
    features = feature_columns(kept.columns)
    split = splits.holdout_split(kept, features)
    return split._replace(train=pinned(split.train), test=pinned(split.test)), features


def _evaluated(scored):
    out = metrics.classification_metrics(scored, ["variant"])
    return out.select("variant", *rounded("pr_auc", "recall_at_p80", "f1", "brier_score", "ece"))


@query("y2_logistic")
def y2_logistic(spark, sf_dir):
    split, features = _learning_split(spark, sf_dir)
    model = models.train_logistic(split.train, features)
    return _evaluated(models.score_risk(model, split.test, features))


@query("y3_random_forest")
def y3_random_forest(spark, sf_dir):
    split, features = _learning_split(spark, sf_dir)
    model = models.train_forest(split.train, features)
    return _evaluated(models.score_risk(model, split.test, features))


@query("y4_boosted_trees")
def y4_boosted_trees(spark, sf_dir):
    split, features = _learning_split(spark, sf_dir)
    model = models.train_boosted(split.train, features)
    return _evaluated(models.score_risk(model, split.test, features))


@query("y5_rul_regressor")
def y5_rul_regressor(spark, sf_dir):
    split, features = _learning_split(spark, sf_dir)
    model = models.train_rul_regressor(split.train, features)
    out = metrics.regression_metrics(models.score_rul(model, split.test, features), ["variant"])
    return out.select("variant", *rounded("mae", "rmse", "asymmetric_penalty"))


@query("s8_model_round_trip")
def s8_model_round_trip(spark, sf_dir):
    """Scores of a saved and reloaded model against the original: largest difference."""
    split, features = _learning_split(spark, sf_dir)
    model = models.train_logistic(split.train, features)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    first = models.score_risk(model, split.test, features)
    second = models.score_risk(models.load_model(path), first.withColumnRenamed("risk", "before"), features)
    return second.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("risk") - F.col("before"))).alias("largest_gap")
    )


@query("y13_importances")
def y13_importances(spark, sf_dir):
    split, features = _learning_split(spark, sf_dir)
    model = models.train_forest(split.train, features)
    return spark.createDataFrame(models.importances(model, features), "feature string, importance double")


def _trained_runs(spark, sf_dir):
    """Stored models of two kinds and the threshold rule, fitted per track and scored on its unseen side."""
    fleet = view.labelled(view.fleet(spark, sf_dir))
    df = pinned(feat.add_features(fleet.df, hot=fleet.hot, dense=True).withColumn("cycle_age", F.col("cycle").cast("double")))
    features = feature_columns(df.columns)
    sides = {}
    for track, cut in (("A", splits.holdout_split), ("B", splits.domain_split)):
        split = cut(df, features)
        sides[track] = pinned(split.train), pinned(split.test)
    kinds = {"boosted": models.train_boosted, "logistic": models.train_logistic, "threshold_rule": None}

    def scored_by(name: str, track: str):
        train, test = sides[track]
        if kinds[name] is None:
            scored = baseline.fit_threshold_rule(train, ["sensor_1", "sensor_2", "sensor_3"]).score(test)
        else:
            path = scratch_path(spark, f"model-{name}-{track}")
            models.save_model(kinds[name](train, features), path)
            scored = models.score_risk(models.load_model(path), test, features)
        return name, track, scored.select("variant", models.LABEL, "risk")

    todo = [(name, track) for name in kinds for track in sides]
    with ThreadPool(len(todo)) as pool:  # the fits are many small jobs; side by side they fill the cluster
        parts = pool.starmap(inheritable_thread_target(spark)(scored_by), todo, chunksize=1)
    whole = None
    for name, track, scored in parts:
        side = scored.select(F.lit(name).alias("model"), F.lit(track).alias("track"), "variant", models.LABEL, "risk")
        whole = side if whole is None else whole.unionByName(side)
    params = {"logistic": {"iterations": "1000"}, "boosted": {"rounds": str(models.BOOST_ROUNDS), "depth": str(models.BOOST_DEPTH)}}
    return runs.evaluated_runs(whole, params, F.lit(dt.datetime(2026, 1, 1)))


@query("g1_trained_runs")
def g1_trained_runs(spark, sf_dir):
    """Run table of trained models on both tracks, appended twice, and the best of them per metric."""
    found, path = pinned(_trained_runs(spark, sf_dir)), scratch_path(spark, "trained-runs")
    for _ in range(2):
        runs.append_new_runs(found, path)
    table = runs.scan_runs(spark, path)
    best = runs.best_per_metric(runs.latest(runs.comparison(table)), ["A_pr_auc", "A_f1", "B_pr_auc", "B_f1"])
    return best.withColumn("n_runs", F.lit(table.count())).select("metric", "model", "variant", *rounded("value"), "n_runs")


_COEF = {"sensor_1": 0.02, "sensor_2": -0.03, "sensor_3": 0.1}


@query(
    "y14_contributions",
    f"""WITH {FLEET}, m AS (SELECT avg(sensor_1) AS a, avg(sensor_2) AS b, avg(sensor_3) AS c FROM fleet),
    k AS (SELECT variant, unit_id, cycle, unnest([
      {{'feature': 'sensor_1', 'value': 0.02e0 * (sensor_1 - a)}}, {{'feature': 'sensor_2', 'value': -0.03e0 * (sensor_2 - b)}},
      {{'feature': 'sensor_3', 'value': 0.1e0 * (sensor_3 - c)}}]) AS e FROM fleet, m)
    SELECT variant, unit_id, cycle, arg_max(e.feature, abs(e.value)) AS top_feature,
      {r6("arg_max(e.value, abs(e.value))")} AS top_value,
      {r6("-1.5e0 + (SELECT 0.02e0 * a - 0.03e0 * b + 0.1e0 * c FROM m) + sum(e.value)")} AS raw_score
    FROM k GROUP BY 1, 2, 3""",
)
def y14_contributions(spark, sf_dir):
    """Largest additive contribution of a linear score per reading."""
    df = view.fleet(spark, sf_dir).df
    means = df.agg(*[F.avg(c).alias(c) for c in _COEF]).first().asDict()
    out = models.add_contributions(df, _COEF, -1.5, means, top=2)
    top = F.col("contributions")[0]
    return out.select(
        *KEYS, "cycle", top["feature"].alias("top_feature"), top["value"].alias("top_value"), *rounded("raw_score")
    )


@query("y16_sequence_classifier")
def y16_sequence_classifier(spark, sf_dir):
    fleet = view.labelled(view.fleet(spark, sf_dir))
    sequences = pinned(feat.add_sequences(fleet.df, ["sensor_1", "sensor_2"], hot=fleet.hot, dense=True))
    sides = pinned(splits.assign_units(fleet.df))
    train = sequences.join(sides.where("is_train"), KEYS, "left_semi")
    test = sequences.join(sides.where("NOT is_train"), KEYS, "left_semi")
    return _evaluated(models.score_sequences(models.train_sequence_classifier(train), test))


@query("y7_fitted_intervals")
def y7_fitted_intervals(spark, sf_dir):
    """Residual-quantile intervals around a fitted regressor: coverage on held-out units."""
    split, features = _learning_split(spark, sf_dir)
    sides = pinned(splits.assign_units(split.train, 0.75, seed=7))  # a quarter of the units calibrates
    fitted = split.train.join(sides.where("is_train"), KEYS, "left_semi")
    unseen = split.train.join(sides.where("NOT is_train"), KEYS, "left_semi")
    model = models.train_rul_regressor(fitted, features)
    calibration = pinned(models.score_rul(model, unseen, features))
    shifts = uncertainty.residual_quantiles(calibration, width=20.0)
    overall = uncertainty.overall_quantiles(calibration)
    scored = uncertainty.add_rul_interval(models.score_rul(model, split.test, features), shifts, 20.0, overall=overall)
    out = metrics.interval_coverage(scored, ["variant"], "rul", "rul_lower", "rul_upper")
    return out.select("variant", "n", *rounded("coverage", "mean_width"))


@query("k8_fitted_schedule")
def k8_fitted_schedule(spark, sf_dir):
    """Last reading of every held-out unit through a fitted classifier and the cost policy."""
    split, features = _learning_split(spark, sf_dir)
    model = models.train_logistic(split.train, features)
    last = feat.last_rows(split.test)
    scored = uncertainty.add_rul_fallback(models.score_risk(model, last, features))
    return policy.alerts(scored, reference_date=dt.date(2026, 1, 1)).orderBy("variant", "unit_id")


# --- members, leaves, permutations -----------------------------------------------------------

def _row_keys():
    return F.col("_variant"), F.col("unit_id"), F.col("cycle")


def _keyed(df):
    return df.withColumn("_variant", text_key(F.col("variant")))


_WEIGHT = " + ".join(f"CAST(u >= {c!r} AS INTEGER)" for c in passes.POISSON)


@query(
    "y12_stochastic_passes",
    f"""WITH {LABELLED}, u AS (SELECT variant, unit_id, cycle, sensor_2 AS x, label_within_x AS y, t,
      {uniform_sql(42, text_key_sql("variant"), "unit_id", "cycle", "t")} AS u FROM labelled, range(50) r(t)),
    w AS (SELECT *, CAST({_WEIGHT} AS DOUBLE) AS w FROM u),
    m AS (SELECT t, sum(w) AS n, sum(w * x) AS sx, sum(w * y) AS sy, sum(w * x * x) AS sxx, sum(w * x * y) AS sxy FROM w GROUP BY t),
    b AS (SELECT t, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope, n, sx, sy FROM m),
    p AS (SELECT variant, unit_id, cycle, greatest(0, least(1, (sy - slope * sx) / n + slope * sensor_2)) AS risk FROM labelled, b)
    SELECT variant, unit_id, cycle, {as_int("count(*)")} AS n_passes, {r6("avg(risk)")} AS risk_mean,
      {r6("stddev_pop(risk)")} AS risk_std FROM p GROUP BY 1, 2, 3""",
)
def y12_stochastic_passes(spark, sf_dir):
    """50 bagged least-squares members from one scan, all of them scoring every reading."""
    df = _keyed(view.labelled(view.fleet(spark, sf_dir)).df)
    members = passes.fit_members(df, ["sensor_2"], _row_keys(), "linear", ridge=0.0)
    return passes.add_passes(df, members).select(*KEYS, "cycle", "n_passes", *rounded("risk_mean", "risk_std"))


@query("y12_logistic_passes")
def y12_logistic_passes(spark, sf_dir):
    """50 bagged logistic members over all features: precision of their mean and their spread on held-out units."""
    split, features = _learning_split(spark, sf_dir)
    members = passes.fit_members(_keyed(split.train), features, _row_keys())
    scored = pinned(passes.add_passes(split.test, members).withColumn("risk", F.col("risk_mean")))
    spread = scored.groupBy("variant").agg(F.min("n_passes").alias("n_passes"), F.avg("risk_std").alias("risk_std"))
    return _evaluated(scored).join(spread, "variant").select("variant", "n_passes", "pr_auc", "brier_score", *rounded("risk_std"))


_LEAVES = ("floor(sensor_2 / 10)", "floor(sensor_3)", "unit_id % 7")


@query(
    "y7_leaf_quantiles",
    f"""WITH {LABELLED}, l AS (SELECT *, [{", ".join(f"CAST({e} AS BIGINT)" for e in _LEAVES)}] AS leaves FROM labelled),
    t AS (SELECT rul, unnest([{{'tree': 1, 'leaf': leaves[1]}}, {{'tree': 2, 'leaf': leaves[2]}}, {{'tree': 3, 'leaf': leaves[3]}}]) AS k
      FROM l WHERE variant IN ('FD001', 'FD003')),
    c AS (SELECT k.tree AS tree, k.leaf AS leaf, rul, count(*) AS n FROM t GROUP BY ALL),
    g AS (SELECT DISTINCT rul AS v FROM l WHERE variant IN ('FD001', 'FD003')),
    f AS (SELECT tree, leaf, v, sum(n) FILTER (rul <= v) / CAST(sum(n) AS DOUBLE) AS share FROM c, g GROUP BY ALL),
    q AS (SELECT DISTINCT leaves FROM l),
    s AS (SELECT leaves, v, sum(coalesce(share, 0)) AS share, count(*) AS trees FROM q
      JOIN f ON (tree = 1 AND leaf = leaves[1]) OR (tree = 2 AND leaf = leaves[2]) OR (tree = 3 AND leaf = leaves[3]) GROUP BY ALL),
    r AS (SELECT leaves, min(v) FILTER (share >= 0.1 * trees - 1e-9) AS lo, min(v) FILTER (share >= 0.9 * trees - 1e-9) AS hi FROM s GROUP BY 1)
    SELECT variant, unit_id, cycle, CAST(lo AS DOUBLE) AS rul_lower, CAST(hi AS DOUBLE) AS rul_upper FROM l LEFT JOIN r USING (leaves)""",
)
def y7_leaf_quantiles(spark, sf_dir):
    """Quantiles of remaining life over the mates in hand-made leaves, two variants for all."""
    df = view.labelled(view.fleet(spark, sf_dir)).df
    df = df.withColumn("leaves", F.array(*[F.expr(e).cast("bigint") for e in _LEAVES]))
    train = df.where(F.col("variant").isin("FD001", "FD003"))
    tables = leaves.leaf_tables(train, "leaves", "rul", leaves.target_grid(train, "rul", 1 << 12))
    out = leaves.add_leaf_quantiles(df, tables, "leaves", {"rul_lower": 0.1, "rul_upper": 0.9})
    return out.select(*KEYS, "cycle", "rul_lower", "rul_upper")


@query("y7_quantile_forest")
def y7_quantile_forest(spark, sf_dir):
    """Coverage and width of the 10 % to 90 % interval of a quantile forest on held-out units."""
    split, features = _learning_split(spark, sf_dir)
    scored = leaves.add_quantile_interval(split.test, leaves.train_quantile_forest(split.train, features))
    out = metrics.interval_coverage(scored, ["variant"], "rul", "rul_lower", "rul_upper")
    return out.select("variant", "n", *rounded("coverage", "mean_width"))


_STEPS = ", ".join(map(str, permutation.STEPS))


@query(
    "y14_permutation",
    f"""WITH {FLEET}, h AS (SELECT *, {text_key_sql("variant")} AS v, {hash_sql(42, text_key_sql("variant"), "unit_id", "cycle")} AS h FROM fleet),
    i AS (SELECT *, row_number() OVER (ORDER BY h, v, unit_id, cycle) - 1 AS i, count(*) OVER () AS n FROM h),
    r AS (SELECT *, list_filter([{_STEPS}], lambda p: n % p <> 0)[1 + r] AS step FROM i, range(3) t(r))
    SELECT r.variant, r.unit_id, r.cycle, CAST(r.r AS INTEGER) AS repeat, r.i AS place, (r.i * step + {permutation.SHIFT} * (r.r + 1)) % r.n AS image,
      o.sensor_2 AS from_sensor_2 FROM r JOIN i o ON o.i = (r.i * step + {permutation.SHIFT} * (r.r + 1)) % r.n""",
)
def y14_permutation(spark, sf_dir):
    """Where three keyed permutations send every reading, and the value it gets."""
    df = _keyed(view.fleet(spark, sf_dir).df)
    indexed = pinned(permutation.add_index(df, _row_keys()))
    out = permutation.permuted(indexed, indexed.count(), 3, ["sensor_2"])
    return out.select(*KEYS, "cycle", "repeat", F.col("_index").alias("place"), F.col("_image").alias("image"), "from_sensor_2")


@query("y14_permutation_importance")
def y14_permutation_importance(spark, sf_dir):
    """Fall of a forest's average precision per feature on held-out units; `noise` is planted."""
    noisy = _keyed(view.labelled(view.fleet(spark, sf_dir)).df).withColumn("noise", key_uniform(5, *_row_keys()))
    features = ["sensor_1", "sensor_2", "sensor_3", "cycle", "noise"]
    split = splits.holdout_split(pinned(noisy), features, scale=False)
    model = models.train_forest(split.train, features)
    out = permutation.permutation_importance(split.test, features, _row_keys(), permutation.risk_of(model))
    return out.select("feature", *rounded("importance", "deviation"))


# --- survival --------------------------------------------------------------------------------

_UNIT = (text_key_sql("variant"), "unit_id")
_ROWS = f"""sized AS (SELECT *, row_number() OVER (PARTITION BY variant, unit_id ORDER BY cycle) AS place,
    count(*) OVER (PARTITION BY variant, unit_id) AS n FROM fleet),
  drawn AS (SELECT *, {uniform_sql(42, *_UNIT, "1")} < 0.3 AND n > 3 AS cens,
    1 + floor({uniform_sql(42, *_UNIT, "2")} * (n - 1)) AS cut FROM sized),
  units AS (SELECT variant, unit_id, arg_max(sensor_1, cycle) AS sensor_1, arg_max(sensor_2, cycle) AS sensor_2,
    max(cycle) AS duration, max(CAST(NOT cens AS INTEGER)) AS event FROM drawn
    WHERE NOT cens OR place <= cut GROUP BY 1, 2)"""


def _units(spark, sf_dir):
    fleet = view.fleet(spark, sf_dir)
    return survival.survival_rows(fleet.df, ["sensor_1", "sensor_2"], hot=fleet.hot)


@query("y8_survival_rows", f"WITH {FLEET}, {_ROWS} SELECT * FROM units")
def y8_survival_rows(spark, sf_dir):
    return _units(spark, sf_dir)


@query("y9_cox_model")
def y9_cox_model(spark, sf_dir):
    model = survival.fit_cox(_units(spark, sf_dir), ["sensor_1", "sensor_2"])
    rows = [(f, float(c)) for f, c in model.coefficients.items()]
    return spark.createDataFrame(rows, "feature string, coefficient double")


_PAIRS = """pairs AS (SELECT a.variant, a.risk AS ra, b.risk AS rb FROM risks a JOIN risks b ON a.variant = b.variant
  AND a.event = 1 AND (b.duration > a.duration OR (b.duration = a.duration AND b.event = 0)))"""


@query(
    "y10_j7_concordance",
    f"""WITH {FLEET}, {_ROWS}, risks AS (SELECT *, sensor_2 - duration AS risk FROM units), {_PAIRS}
    SELECT variant, CAST(count(*) AS DOUBLE) AS comparable,
    {r6("(count(*) FILTER (ra > rb) + 0.5e0 * count(*) FILTER (ra = rb)) / count(*)")} AS c_index FROM pairs GROUP BY 1""",
)
def y10_j7_concordance(spark, sf_dir):
    units = _units(spark, sf_dir).withColumn("hazard", F.col("sensor_2") - F.col("duration"))
    found = survival.concordance(units, ["variant"]).where("comparable > 0")
    return found.select("variant", "comparable", *rounded("c_index"))


@query("y11_concordance_interval")
def y11_concordance_interval(spark, sf_dir):
    units = _units(spark, sf_dir).withColumn("hazard", F.col("sensor_2") - F.col("duration"))
    return survival.concordance_interval(units)


@query(
    "x6_bootstrap_sizes",
    f"""WITH {FLEET}, n AS (SELECT count(*) AS n FROM (SELECT DISTINCT variant, unit_id FROM fleet))
    SELECT CAST(s AS INTEGER) AS sample, {as_int("n")} AS n_drawn FROM n, range(200) r(s)""",
)
def x6_bootstrap_sizes(spark, sf_dir):
    """Every resample draws exactly n units."""
    units = splits.units_of(view.fleet(spark, sf_dir).df)
    drawn = survival.bootstrap_weights(units)
    return drawn.groupBy("sample").agg(F.sum("weight").alias("n_drawn"))


# --- streaming -------------------------------------------------------------------------------


def _event_stream(spark, sf_dir):
    schema = view.table(spark, sf_dir, "events").schema
    return jobs.read_stream(spark, f"{sf_dir}/events.parquet*", schema)


def _as_readings(events):
    return events.select(
        F.concat(F.lit("FD00"), (F.lit(1) + F.col("user_id") % 4).cast("string")).alias("variant"),
        F.col("user_id").alias("unit_id"),
        (F.col("event_id") + 1).alias("cycle"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("sensor_1"),
        (F.get_json_object("props", "$.k").cast("double") * 2.5 + 490.0).alias("sensor_2"),
    )


@query(
    "st1_stream_scoring",
    """WITH e AS (SELECT 'FD00' || CAST(1 + user_id % 4 AS VARCHAR) AS variant, CAST(user_id AS BIGINT) AS unit_id,
      CAST(event_id + 1 AS BIGINT) AS cycle, event_type <> 'error' AS seen,
      CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) * 2.5 + 490 AS s2 FROM events),
    v AS (SELECT *, seen AND s2 BETWEEN 500 AND 700 AND unit_id >= 1 AS is_valid, (s2 - 490) / 250e0 AS risk FROM e)
    SELECT variant, unit_id, cycle, is_valid, CASE WHEN is_valid THEN round_even(risk, 4) END AS risk_score,
      CASE WHEN is_valid THEN risk >= 0.5 END AS replace_within_30,
      CASE WHEN is_valid THEN CASE WHEN 8000 <= 400 + risk * 8000 + (1 - risk) * 200 AND 8000 <= risk * 50000 THEN 'replace'
        WHEN 400 + risk * 8000 + (1 - risk) * 200 <= risk * 50000 THEN 'inspect' ELSE 'continue' END END AS action FROM v""",
)
def st1_stream_scoring(spark, sf_dir):
    """Score a stream of readings into a sink partitioned by validity, then read the sink."""
    readings = _as_readings(_event_stream(spark, sf_dir))
    out = jobs.score_stream(
        readings,
        lambda df: df.withColumn("risk", (F.col("sensor_2") - 490.0) / 250.0),
        rules=rules_for(readings, SERVING_RULES), q_hat=0.1, reference_date=dt.date(2026, 1, 1),
    )
    target = scratch_path(spark, "stream-scores")
    jobs.run_available(out, target, scratch_path(spark, "stream-scores-log"), ["is_valid"])
    return spark.read.parquet(target).select(
        *KEYS, "cycle", F.col("is_valid").cast("boolean").alias("is_valid"), "risk_score", "replace_within_30", "action"
    )


def _all_sensors(events):
    """Readings with all sensors: values inside the serving ranges, but one sensor of every fiftieth reading."""
    part = {s: F.lit(r[0]) + (r[1] - r[0]) * ((F.col("event_id") * i) % 101 + 1) / 103.0
            for i, (s, r) in enumerate(((s, SERVING_RANGES.get(s, (0.0, 103.0))) for s in SENSORS), 1)}
    bad = [F.when((F.col("event_id") % 50 == 7) & (F.floor(F.col("event_id") / 50) % len(SENSORS) == i), F.lit(None).cast("double")).otherwise(v)
           for i, v in enumerate(part.values())]
    return events.select(
        F.concat(F.lit("FD00"), (F.lit(1) + F.col("user_id") % 4).cast("string")).alias("variant"),
        F.col("user_id").cast("bigint").alias("unit_id"), (F.col("event_id") + 1).cast("bigint").alias("cycle"),
        F.col("ts").cast("timestamp").alias("seen_at"), (F.col("event_type") == "error").cast("int").alias(models.LABEL),
        *[v.alias(s) for s, v in zip(part, bad)],
    )


@query(
    "st1_model_stream",
    f"""SELECT 'FD00' || CAST(1 + user_id % 4 AS VARCHAR) AS variant, CAST(user_id AS BIGINT) AS unit_id,
      CAST(event_id + 1 AS BIGINT) AS cycle, user_id >= 1 AND event_id % 50 <> 7 AS is_valid, {as_int("1")} AS n_outputs,
      user_id >= 1 AND event_id % 50 <> 7 AS same_as_batch FROM events""",
)
def st1_model_stream(spark, sf_dir):
    """A fitted classifier inside a stream that delivers its input twice: one output a reading, checked on
    all sensors, with the risk that the model gives in batch (NULL where the reading is invalid)."""
    events = view.table(spark, sf_dir, "events")
    readings = _all_sensors(evenly(events, events.count()))  # large files may be read in few parts
    model = models.train_logistic(readings, SENSORS, iterations=20)
    source = scratch_path(spark, "stream-replayed")
    for _ in range(2):
        events.write.mode("append").parquet(source)
    files = 4  # of both deliveries, so that repeats arrive in later triggers as well
    stream = _all_sensors(jobs.read_stream(spark, source, events.schema, files))
    once = jobs.without_replays(stream, "seen_at", "400 days")
    checked = rules_for(once, SERVING_RULES)  # no operating settings in this view, all sensors
    out = jobs.score_stream(once, jobs.model_score(model, SENSORS), rules=checked, reference_date=dt.date(2026, 1, 1))
    target = scratch_path(spark, "stream-model-scores")
    jobs.run_available(out, target, scratch_path(spark, "stream-model-log"))
    batch = models.score_risk(model, readings, SENSORS).select("unit_id", "cycle", F.round("risk", 4).alias("wanted"))
    found = spark.read.parquet(target).groupBy("variant", "unit_id", "cycle", "is_valid").agg(
        F.count(F.lit(1)).alias("n_outputs"), F.max("risk_score").alias("risk_score")
    )
    same = F.coalesce(F.abs(F.col("risk_score") - F.col("wanted")) <= 1e-4, F.lit(False))
    return found.join(batch, ["unit_id", "cycle"]).select(*KEYS, "cycle", F.col("is_valid").cast("boolean").alias("is_valid"), "n_outputs", same.alias("same_as_batch"))


_W = "OVER (PARTITION BY unit_id ORDER BY cycle ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


@query(
    "st2_stream_quality",
    f"""WITH e AS (SELECT 'FD00' || CAST(1 + user_id % 4 AS VARCHAR) AS variant, CAST(user_id AS BIGINT) AS unit_id,
      CAST(event_id + 1 AS BIGINT) AS cycle, CASE WHEN event_type <> 'error' THEN value END AS x FROM events)
    SELECT variant, unit_id, cycle, CASE WHEN count(x) {_W.format(n=9)} >= 5 AND stddev_samp(x) {_W.format(n=9)} < 1e-4
      THEN true ELSE false END AS is_flat, {r6("avg(CAST(x IS NULL AS INTEGER)) " + _W.format(n=19))} AS missing_rate,
      avg(CAST(x IS NULL AS INTEGER)) {_W.format(n=19)} > 0.05 AS is_spike FROM e""",
)
def st2_stream_quality(spark, sf_dir):
    """Stateful flags on a stream, equal to the batch windows."""
    flags = jobs.quality_stream(_as_readings(_event_stream(spark, sf_dir)), ["sensor_1"], idle_ms=None)
    target = scratch_path(spark, "stream-flags")
    jobs.run_available(flags, target, scratch_path(spark, "stream-flags-log"))
    return spark.read.parquet(target).select(*KEYS, "cycle", "is_flat", *rounded("missing_rate"), "is_spike")


def _epoch(column: str):
    """Seconds on the clock of the session, as the stored timestamps have no zone."""
    local = F.col(column).cast("timestamp_ntz")
    clock = F.hour(local) * 3600 + F.minute(local) * 60 + F.second(local)
    return (F.unix_date(F.to_date(local)).cast("bigint") * 86400 + clock).alias(column)


@query(
    "st3_tumbling_windows",
    f"""SELECT {as_int("epoch(date_trunc('hour', ts))")} AS start, event_type, {as_int("count(*)")} AS n,
    {r6("avg(value)")} AS mean_value FROM events GROUP BY 1, 2""",
)
def st3_tumbling_windows(spark, sf_dir):
    events = view.table(spark, sf_dir, "events")
    out = jobs.windowed_readings(events, "tumbling", keys=["event_type"])
    return out.select(_epoch("start"), "event_type", "n", *rounded("mean_value"))


@query(
    "st3_sliding_windows",
    f"""WITH s AS (SELECT epoch(date_trunc('hour', ts)) - 3600 * k AS start, value FROM events, range(2) r(k))
    SELECT {as_int("start")} AS start, {as_int("count(*)")} AS n, {r6("avg(value)")} AS mean_value FROM s GROUP BY 1""",
)
def st3_sliding_windows(spark, sf_dir):
    out = jobs.windowed_readings(
        view.table(spark, sf_dir, "events"), "sliding", length="2 hours", slide="1 hour"
    )
    return out.select(_epoch("start"), "n", *rounded("mean_value"))


@query(
    "st3_session_windows",
    f"""WITH o AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT user_id, ts, value, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
    SELECT user_id, {as_int("floor(epoch(min(ts)))")} AS start, {as_int("count(*)")} AS n, {r6("avg(value)")} AS mean_value
    FROM s GROUP BY user_id, sid""",
)
def st3_session_windows(spark, sf_dir):
    out = jobs.windowed_readings(
        view.table(spark, sf_dir, "events"), "session", keys=["user_id"], gap="6 hours"
    )
    return out.select("user_id", _epoch("start"), "n", *rounded("mean_value"))


@query(
    "st3_stream_windows",
    f"""SELECT {as_int("epoch(date_trunc('hour', ts))")} AS start, {as_int("count(*)")} AS n,
    {r6("avg(value)")} AS mean_value FROM events GROUP BY 1
    HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def st3_stream_windows(spark, sf_dir):
    """Tumbling windows of a stream with a watermark: windows the watermark has passed."""
    out = jobs.windowed_readings(_event_stream(spark, sf_dir), "tumbling", delay="10 minutes")
    target = scratch_path(spark, "stream-windows")
    jobs.run_available(out, target, scratch_path(spark, "stream-windows-log"))
    return spark.read.parquet(target).select(_epoch("start"), "n", *rounded("mean_value"))
