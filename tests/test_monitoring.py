"""Quality alerts, drift, corruption and the streaming checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import corrupt, drift, quality, rules
from fleetgauge.streaming import jobs

VALUES = np.random.default_rng(42).normal(500, 20, (6, 60))
SENSORS = ["sensor_1", "sensor_2"]


@pytest.fixture(scope="module")
def clean(readings):
    def value(u, c, s):
        return float(VALUES[u, c - 1] + (3 if s == "sensor_2" else 0))

    return readings({u: 50 for u in range(1, 6)}, SENSORS, value).cache()


def test_clean_data_is_silent(clean):
    row = quality.alert_totals(quality.quality_alerts(clean, SENSORS)).first()
    assert row["total_alerts"] == 0


@pytest.mark.parametrize("hot", [False, True])
def test_frozen_sensor_is_listed(clean, hot):
    stuck = (F.col("unit_id") == 2) & (F.col("cycle") >= 11)
    df = clean.withColumn("sensor_1", F.when(stuck, F.lit(510.0)).otherwise(F.col("sensor_1")))
    row = quality.flatline_alerts(df, SENSORS, hot=hot, rows=12).collect()
    assert len(row) == 1 and row[0]["unit_id"] == 2 and row[0]["sensor"] == "sensor_1"
    assert row[0]["n_cycles"] == 31 and row[0]["cycles"] == list(range(20, 40))


@pytest.mark.parametrize("hot", [False, True])
def test_missing_spike_rate(clean, hot):
    df = clean.withColumn("sensor_2", F.when(~((F.col("unit_id") == 3) & F.col("cycle").isin(5, 6)), F.col("sensor_2")))
    row = quality.spike_alerts(df, SENSORS, hot=hot, rows=21).collect()
    assert len(row) == 1 and row[0]["max_nan_rate"] == pytest.approx(0.3333)
    assert row[0]["n_cycles"] == 20 and row[0]["cycles"] == list(range(5, 25))


def test_dropout_rates(clean):
    total = clean.count()
    for rate in (0.0, 0.2, 1.0):
        out = corrupt.inject_missing(clean, SENSORS, rate)
        lost = out.where("sensor_1 IS NULL").count()
        assert lost / total == pytest.approx(rate, abs=0.05 if 0 < rate < 1 else 0)
    assert clean.where("sensor_1 IS NULL").count() == 0


def test_corruption_ignores_layout(clean):
    pick = lambda d: sorted(tuple(r) for r in d.select("unit_id", "cycle", "sensor_1").fillna(-1.0).collect())
    a = corrupt.inject_missing(clean.repartition(1), SENSORS, 0.3)
    b = corrupt.inject_missing(clean.repartition(9), SENSORS, 0.3)
    assert pick(a) == pick(b)


def test_noise_levels(clean):
    levels = corrupt.noise_levels(clean.withColumn("flat", F.lit(3.0)), ["sensor_1", "flat", "absent"], 20.0)
    std = np.std(VALUES[1:6, :50])
    assert levels["sensor_1"] == pytest.approx(std / 10) and levels["flat"] == 0.01 and "absent" not in levels
    quiet = corrupt.inject_noise(clean.withColumn("kept", F.col("sensor_1")), SENSORS, 60.0)
    gap = quiet.agg(F.max(F.abs(F.col("sensor_1") - F.col("kept")))).first()[0]
    assert 0 < gap < 5


@pytest.mark.parametrize("hot", [False, True])
def test_frozen_block_is_contiguous(clean, hot):
    out = corrupt.inject_flatline(clean, ["sensor_1"], 0.2, hot=hot, rows=17)
    pdf = out.toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    before = clean.toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    changed = np.flatnonzero(pdf["sensor_1"] != before["sensor_1"])
    start = changed[0] - 1
    assert (pdf["sensor_1"].iloc[start : start + 50] == before["sensor_1"].iloc[start]).all()
    assert changed[-1] == start + 49 and (pdf["sensor_2"] == before["sensor_2"]).all()


def test_corruption_raises_alerts(clean):
    lost = corrupt.inject_missing(clean, SENSORS, 0.3)
    assert quality.spike_alerts(lost, SENSORS).count() >= 1
    stuck = corrupt.inject_flatline(clean, SENSORS, 0.4)
    assert quality.flatline_alerts(stuck, SENSORS).count() >= 1


def brute_distances(a, b):
    points = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), points, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), points, side="right") / len(b)
    gap = np.abs(fa - fb)
    return gap.max(), (gap[:-1] * np.diff(points)).sum() / a.std()


def test_drift_distances(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, 400), rng.normal(0.5, 2, 300)
    ref = spark.createDataFrame([(float(v), 1.0) for v in a], "x double, same double")
    cur = spark.createDataFrame([(float(v), 1.0) for v in b], "x double, same double")
    rows = {r["feature"]: r for r in drift.drift_report(ref, cur, ["x", "same"], method="ks").collect()}
    ks, area = brute_distances(a, b)
    assert rows["x"]["ks"] == pytest.approx(ks) and rows["x"]["wasserstein"] == pytest.approx(area)
    assert rows["x"]["drifted"] and not rows["same"]["drifted"] and rows["x"]["method"] == "ks"
    summary = drift.drift_summary(drift.drift_report(ref, cur, ["x", "same"], method="ks")).first()
    assert summary["drift_share"] == 0.5 and summary["drifted_columns"] == ["x"]


def test_area_between_equal_distributions(spark):
    rng = np.random.default_rng(0)
    ref = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 1500)], "x double")
    cur = spark.createDataFrame([(float(v),) for v in rng.normal(0, 1, 1500)], "x double")
    row = drift.drift_report(ref, cur, ["x"], method="wasserstein").first()
    assert row["method"] == "wasserstein" and not row["drifted"]


def test_stream_flags_equal_batch_and_late_rows_are_marked(spark, clean, tmp_path):
    stuck = (F.col("unit_id") == 2) & (F.col("cycle") >= 11)
    df = clean.withColumn("sensor_1", F.when(stuck, F.lit(510.0)).otherwise(F.col("sensor_1")))
    df = df.withColumn("sensor_2", F.when(F.col("cycle") % 9 != 0, F.col("sensor_2")))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [df.where("cycle <= 23"), df.where("cycle > 23"), df.where("unit_id = 1 and cycle = 30")]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        flags = jobs.quality_stream(jobs.read_stream(spark, source, df.schema, 1), SENSORS, idle_ms=None)
        jobs.run_available(flags, out, str(tmp_path / "log"))
    found = spark.read.parquet(out)
    assert found.where("event = 'late'").count() == 2 and found.where("event = 'reading'").count() == 500
    assert {r["late_rows"] for r in found.where("event = 'late'").collect()} == {1}
    by_series = found.where("is_flat").groupBy("unit_id", "sensor").count().collect()
    batch = quality.flatline_alerts(df, SENSORS).collect()
    assert {(r["unit_id"], r["sensor"], r["count"]) for r in by_series} == {
        (r["unit_id"], r["sensor"], r["n_cycles"]) for r in batch
    }
    spikes = found.where("is_spike").groupBy("unit_id", "sensor").agg(F.count("*").alias("n")).collect()
    assert {(r["unit_id"], r["sensor"], r["n"]) for r in spikes} == {
        (r["unit_id"], r["sensor"], r["n_cycles"]) for r in quality.spike_alerts(df, SENSORS).collect()
    }


def test_a_silent_unit_expires_and_starts_anew(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(rows):
        spark.createDataFrame(rows, "variant string, unit_id long, cycle long, sensor_1 double").coalesce(1).write.mode("append").parquet(source)
        stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema, 1)
        jobs.run_available(jobs.quality_stream(stream, ["sensor_1"], idle_ms=1), out, str(tmp_path / "log"), idle_batches=False)
        return [tuple(r) for r in spark.read.parquet(out).orderBy("unit_id", "cycle", "event").select("unit_id", "cycle", "event", "is_flat").collect()]

    big = 3_000_000_000
    arrive([("FD001", big, c, 5.0) for c in range(1, 7)])
    arrive([("FD001", 2, 1, 1.0)])
    found = arrive([("FD001", big, 3, 5.0)])  # after expiry an old cycle is a first reading again
    assert (big, 6, "expired", None) in found and (big, 3, "reading", False) in found
    assert (big, 3, "late", None) not in found


def test_a_stream_delivered_twice_is_scored_once(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.range(40).selectExpr("'FD001' AS variant", "id % 4 + 1 AS unit_id", "id AS cycle", "timestamp_seconds(1700000000 + id * 60) AS t", "CAST(id AS double) AS x")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(source)
    once = jobs.without_replays(jobs.read_stream(spark, source, rows.schema, 1), "t", "2 hours")
    jobs.run_available(once, str(tmp_path / "out"), str(tmp_path / "log"))
    assert sorted(r["cycle"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(40))


def test_stream_scores_reject_bad_readings(spark, clean, tmp_path):
    source = str(tmp_path / "in")
    clean.select("variant", "unit_id", "cycle", F.col("sensor_1").alias("sensor_2")).write.parquet(source)
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema)
    def score(d):
        return d.withColumn("risk", F.lit(0.3))

    whole = jobs.score_stream(spark.read.parquet(source), score)  # readings without settings break the full rules
    assert whole.where("is_valid").count() == 0
    out = jobs.score_stream(stream, score, rules.rules_for(stream, rules.SERVING_RULES), q_hat=0.2)
    jobs.run_available(out, str(tmp_path / "out"), str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == 250
    bad = rows.where("NOT is_valid")
    assert bad.count() == clean.where("sensor_1 < 500").count() and bad.where("urgency IS NOT NULL").count() == 0
    good = rows.where("is_valid").first()
    assert good["urgency"] == "scheduled" and good["risk_upper"] == 0.5


@pytest.mark.parametrize("hot", [False, True])
def test_stressed_readings_keep_every_row_four_times(clean, hot):
    found = corrupt.stressed(clean, ["sensor_1", "absent"], rate=0.3, fraction=0.1, hot=hot, rows=40).cache()
    n = clean.count()
    assert {r[0]: r[1] for r in found.groupBy("corruption").count().collect()} == dict.fromkeys(
        ["clean", "missing", "noise", "flatline"], n
    )
    keys = ["variant", "unit_id", "cycle"]
    before = clean.select(*keys, F.coalesce("sensor_1", F.lit(0.0)).alias("was"))
    same = found.join(before, keys).groupBy("corruption").agg(F.count_if(F.expr("sensor_1 = was")).alias("n"))
    kept = {r[0]: r["n"] for r in same.collect()}
    assert kept["clean"] == n and kept["noise"] == 0
    assert 0.5 * n < kept["missing"] < 0.9 * n and 0.85 * n <= kept["flatline"] < n
    assert found.where("sensor_1 IS NULL").isEmpty()


def test_stressed_rows_are_drawn_once(clean):
    found = corrupt.stressed(clean, SENSORS).where("sensor_1 > 0")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "Window" not in plan  # a filter on top repeats no draw
