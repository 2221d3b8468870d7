"""Labels, window features, splits and statistics against pandas and hand values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import features as feat
from fleetgauge.operators import labels, splits, stats

RNG = np.random.default_rng(7)
NOISE = RNG.normal(500, 20, (3, 70))


def noisy(u, c, s):
    if (u * 7 + c * 3) % 11 == 0 and s == "sensor_2":
        return None
    return float(NOISE[u % 3, c - 1])


def slope(y):
    if len(y) < 2 or np.isnan(y).any():
        return np.nan
    return np.polyfit(np.arange(len(y)), y, 1)[0]


def expected(pdf, sensor, windows, lags):
    parts = []
    for _, unit in pdf.sort_values("cycle").groupby("unit_id"):
        out = unit[["unit_id", "cycle"]].copy()
        x = unit[sensor]
        for w in windows:
            rolled = x.rolling(w, min_periods=max(1, w // 2))
            out[f"{sensor}_mean_w{w}"] = rolled.mean()
            out[f"{sensor}_std_w{w}"] = rolled.std()
            frames = [x.iloc[max(0, i - w + 1) : i + 1].to_numpy() for i in range(len(x))]
            counts = np.array([np.count_nonzero(~np.isnan(f)) for f in frames])
            slopes = np.array([slope(f) for f in frames])
            slopes[counts < max(1, w // 2)] = np.nan
            out[f"{sensor}_slope_w{w}"] = slopes
        for k in lags:
            out[f"{sensor}_lag{k}"] = x.shift(k)
        parts.append(out)
    return pd.concat(parts).sort_values(["unit_id", "cycle"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def fleet(readings):
    return readings({1: 70, 2: 41, 3: 4}, ("sensor_1", "sensor_2"), noisy).cache()


@pytest.mark.parametrize("windows", [[10, 20, 30], [7], [5, 8], [2, 4]])
@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("sensor", ["sensor_1", "sensor_2"])
def test_rolling_features_equal_pandas(fleet, windows, hot, sensor):
    out = feat.add_features(fleet, [sensor], windows, [1, 3], hot=hot, rows=33)
    found = out.toPandas().sort_values(["unit_id", "cycle"]).reset_index(drop=True)
    want = expected(fleet.toPandas(), sensor, windows, [1, 3])
    for name in want.columns[2:]:
        a, b = found[name].to_numpy(dtype=float), want[name].to_numpy(dtype=float)
        assert (np.isnan(a) == np.isnan(b)).all(), name
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9, equal_nan=True), name


def test_long_layout_equals_wide(fleet):
    wide = feat.add_features(fleet, ["sensor_1", "sensor_2"], hot=False)
    long = feat.long_features(fleet, ["sensor_1", "sensor_2"], hot=True, rows=40)
    picked = long.where("sensor = 'sensor_2'").select("unit_id", "cycle", "std_w20", "lag5")
    want = wide.select("unit_id", "cycle", F.col("sensor_2_std_w20"), F.col("sensor_2_lag5"))
    a = picked.toPandas().sort_values(["unit_id", "cycle"]).to_numpy(dtype=float)
    b = want.toPandas().sort_values(["unit_id", "cycle"]).to_numpy(dtype=float)
    assert np.allclose(a, b, equal_nan=True)


def test_transformer_names_and_round_trip(fleet, tmp_path):
    stage = feat.RollingLagTransformer(sensors=["sensor_1"], windowSizes=[10], lagSteps=[1])
    stage.write().save(str(tmp_path / "stage"))
    again = feat.RollingLagTransformer.load(str(tmp_path / "stage"))
    names = [c for c in again.transform(fleet).columns if c not in fleet.columns]
    assert names == ["sensor_1_mean_w10", "sensor_1_std_w10", "sensor_1_slope_w10", "sensor_1_lag1"]


def test_default_feature_count():
    total = 24 + sum(len(feat.derived_names(f"sensor_{i}", [10, 20, 30], [1, 3, 5])) for i in range(21))
    assert total == 276


@pytest.mark.parametrize("hot", [False, True])
def test_sequences_per_unit(fleet, hot):
    out = feat.add_sequences(fleet, ["sensor_1", "sensor_2"], 30, hot=hot, rows=35)
    counts = {r["unit_id"]: r["count"] for r in out.groupBy("unit_id").count().collect()}
    assert counts == {1: 41, 2: 12}
    first = out.where("unit_id = 2 and cycle = 30").first()["sequence"]
    assert len(first) == 30 and len(first[0]) == 2


@pytest.mark.parametrize("hot", [False, True])
def test_rul_labels(readings, hot):
    df = labels.add_binary_label(labels.add_rul(readings({1: 5, 2: 10}), hot), 3)
    rows = {(r["unit_id"], r["cycle"]): r for r in df.collect()}
    assert rows[1, 1]["rul"] == 4 and rows[2, 1]["rul"] == 9 and rows[2, 10]["rul"] == 0
    assert [c for c in range(1, 11) if rows[2, c]["label_within_x"] == 1] == [7, 8, 9, 10]


def test_label_needs_rul_and_negative_horizon(readings):
    df = readings({1: 5})
    with pytest.raises(ValueError):
        labels.add_binary_label(df)
    out = labels.add_binary_label(labels.add_rul(df, False), -1)
    assert out.agg(F.sum("label_within_x")).first()[0] == 0


def test_truth_labels(spark, readings):
    truth = spark.createDataFrame([("FD001", 1, 12)], "variant string, unit_id int, true_rul int")
    out = labels.add_rul_from_truth(readings({1: 5, 2: 3}), truth, False)
    assert sorted((r["cycle"], r["rul"]) for r in out.collect()) == [(1, 16), (2, 15), (3, 14), (4, 13), (5, 12)]


def test_last_rows(fleet):
    found = {r["unit_id"]: r["cycle"] for r in feat.last_rows(fleet).collect()}
    assert found == {1: 70, 2: 41, 3: 4}


def test_holdout_is_exact_disjoint_and_deterministic(readings):
    df = readings({u: 2 for u in range(1, 24)})
    a = splits.holdout_split(df, ["sensor_1"])
    b = splits.holdout_split(df.repartition(7), ["sensor_1"])
    units = lambda d: {r["unit_id"] for r in d.select("unit_id").distinct().collect()}
    assert len(units(a.train)) == int(23 * 0.8) and len(units(a.test)) == 23 - int(23 * 0.8)
    assert units(a.train) == units(b.train) and splits.shared_units(a.train, a.test).count() == 0


def test_scaler_population_std_and_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    scaler = splits.fit_scaler(df, ["a", "b"])
    values = np.array([1.0, 3.0, 0.0])
    assert scaler.std["a"] == pytest.approx(values.std()) and scaler.std["b"] == 1.0
    scaled = [r["a"] for r in scaler.apply(df).collect()]
    assert np.allclose(scaled, (values - values.mean()) / values.std())


def test_stratified_holdout_counts(readings):
    df = labels.add_binary_label(labels.add_rul(readings({u: 20 for u in range(1, 11)}), False), 4)
    out = splits.stratified_holdout(df, ratio=0.1)
    held = {r["label_within_x"]: r["n"] for r in out.where("is_holdout").groupBy("label_within_x").agg(F.count("*").alias("n")).collect()}
    assert held == {0: 15, 1: 5} and out.count() == 200


def test_spearman_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"rul": rng.integers(0, 20, 200), "a": rng.integers(0, 9, 200).astype(float)})
    pdf["b"] = -pdf["rul"] + rng.normal(0, 3, 200)
    pdf["c"] = 4.0
    pdf.loc[::5, "b"] = np.nan
    rows = [
        (int(r), float(a), None if np.isnan(b) else float(b), float(c))
        for r, a, b, c in pdf[["rul", "a", "b", "c"]].itertuples(index=False)
    ]
    df = spark.createDataFrame(rows, "rul int, a double, b double, c double")
    found = {r["sensor"]: r["rho"] for r in stats.spearman(df, ["a", "b", "c"]).collect()}
    for s in ("a", "b"):
        sub = pdf[[s, "rul"]].dropna()
        assert found[s] == pytest.approx(sub[s].rank().corr(sub["rul"].rank()))
    assert found["c"] == 0.0
    best = stats.best_sensor(stats.spearman(df, ["a", "b", "c"]), ["a", "b", "c"]).first()
    assert best["sensor"] == "b"


def test_spearman_needs_ten_pairs(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(9)], "rul int, a double")
    assert stats.spearman(df, ["a"]).first()["rho"] == 0.0


def test_regimes_are_ordered_by_centre(spark):
    rows = [(float(c * 10 + d), 0.0) for c in range(3) for d in (0, 1)]
    df = spark.createDataFrame(rows, "op_setting_1 double, op_setting_2 double")
    out = stats.regimes(df, ["op_setting_1"], k=3).orderBy("op_setting_1").collect()
    assert [r["op_regime"] for r in out] == [0, 0, 1, 1, 2, 2]


@pytest.mark.parametrize("hot", [False, True])
def test_frames_go_on_from_batch_to_batch(spark, hot):
    """Small batches, gaps, a constant sensor and one of another type: as the window functions give them."""
    from fleetgauge.functions.ordering import blocks
    from fleetgauge.schema import CYCLE, KEYS

    df = spark.range(900).select(
        F.lit("v").alias("variant"), (F.col("id") % 7).alias("unit_id"), F.col("id").cast("int").alias("cycle"),
        F.when(F.col("id") * 31 % 10 > 1, F.sin("id") * 1e4).alias("sensor_1"), (F.col("id") * 17 % 5).cast("int").alias("sensor_2"),
        F.lit(0.1).alias("sensor_3"),
    )
    rows = 40 if hot else 250_000
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "13")
    try:
        out = feat.add_features(df, hot=hot, rows=rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = {r["cycle"]: r for r in out.collect()}
    finally:
        spark.conf.set(name, before)
    assert "MapInArrow" in plan and "covar_pop" not in plan
    sensors = ["sensor_1", "sensor_2", "sensor_3"]
    framed, parts, finish = blocks(df, KEYS, CYCLE, 29, rows, hot)
    stages = [feat._derived(s, s, [10, 20, 30], [1, 3, 5], parts) for s in sensors]
    wanted = {r["cycle"]: r for r in finish(feat._apply(framed, stages)).select(*out.columns).collect()}
    assert len(wanted) == 900 and found.keys() == wanted.keys()
    for cycle, row in wanted.items():
        same = [a == b or (a is not None and b is not None and a == pytest.approx(b, rel=1e-9, abs=1e-9)) for a, b in zip(found[cycle], row)]
        assert all(same), cycle


def test_the_scaler_aggregates_few_numbers_at_a_time(spark, monkeypatch):
    from fleetgauge.operators import splits

    seen, taken = [], splits.scaler_statistics
    monkeypatch.setattr(splits, "scaler_statistics", lambda df, names: seen.append(len(names)) or taken(df, names))
    df = spark.range(9).select(*[(F.col("id") * i).cast("double").alias(f"x{i}") for i in range(41)])
    scaler = splits.fit_scaler(df, df.columns)
    assert max(seen) * 5 < 100 and sum(seen) == 41
    assert scaler.mean["x40"] == 160.0 and scaler.std["x0"] == 1.0
