"""Fitted models recover what was put in; concordance and hazards against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.operators import models, survival


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=600), rng.normal(size=600)
    y = (rng.random(600) < 1 / (1 + np.exp(-(2 * a - b)))).astype(int)
    rows = [("FD001", i // 20, i % 20, float(p), float(q), int(v), float(50 + 10 * p)) for i, (p, q, v) in enumerate(zip(a, b, y))]
    return spark.createDataFrame(
        rows, "variant string, unit_id int, cycle int, a double, b double, label_within_x int, rul double"
    ).cache()


def test_logistic_direction_and_reload(labelled, tmp_path):
    model = models.train_logistic(labelled, ["a", "b"], 100)
    terms, _ = models.linear_terms(model, ["a", "b"])
    assert terms["a"] > 1 and terms["b"] < -0.5
    models.save_model(model, str(tmp_path / "m"))
    key = ["unit_id", "cycle"]
    first = models.score_risk(model, labelled, ["a", "b"]).select(*key, "risk")
    again = models.score_risk(models.load_model(str(tmp_path / "m")), labelled, ["a", "b"]).select(*key, F.col("risk").alias("r2"))
    assert first.join(again, key).agg(F.max(F.abs(F.col("risk") - F.col("r2")))).first()[0] < 1e-6


@pytest.mark.parametrize("train", [
    lambda d: models.train_forest(d, ["a", "b"], trees=10, depth=5),
    lambda d: models.train_boosted(d, ["a", "b"], rounds=5, depth=3),
])
def test_tree_scores_are_bounded_and_rank_well(labelled, train):
    model = train(labelled)
    scored = models.score_risk(model, labelled.withColumn("b", F.when(F.col("cycle") > 2, F.col("b"))), ["a", "b"])
    low, high = scored.agg(F.min("risk"), F.max("risk")).first()
    assert 0 <= low and high <= 1
    assert models.AveragePrecisionEvaluator().evaluate(scored) > 0.75
    assert models.importances(model, ["a", "b"])[0][0] == "a"


def test_rul_regressor_is_not_negative(labelled):
    model = models.train_rul_regressor(labelled, ["a", "b"], rounds=5, depth=3)
    scored = models.score_rul(model, labelled, ["a", "b"])
    assert scored.agg(F.min("predicted_rul")).first()[0] >= 0
    assert scored.agg(F.corr("predicted_rul", "rul")).first()[0] > 0.8


def test_search_reports_every_trial(labelled):
    settings = [{**s, "rounds": 2, "depth": 2} for s in models.sample_parameters(2)]
    found = models.search_boosted(labelled, ["a", "b"], settings=settings)
    assert found.results.count() == 2 and found.setting in settings


def test_contributions_add_up(spark):
    df = spark.createDataFrame([(2.0, None)], "a double, b double")
    row = models.add_contributions(df, {"a": 1.0, "b": -3.0}, 0.5, {"a": 1.0, "b": 2.0}).first()
    assert row["base_value"] == -4.5 and [c["feature"] for c in row["contributions"]] == ["b", "a"]
    assert row["raw_score"] == pytest.approx(row["base_value"] + sum(c["value"] for c in row["contributions"]))


def brute_concordance(t, e, r):
    won = tied = total = 0
    for i in range(len(t)):
        for j in range(len(t)):
            if e[i] and (t[j] > t[i] or (t[j] == t[i] and not e[j])):
                total += 1
                won += r[i] > r[j]
                tied += r[i] == r[j]
    return (won + tied / 2) / total, total


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 2))
    t = np.ceil(rng.exponential(20 / np.exp(x[:, 0] - 0.5 * x[:, 1]))).astype(int)
    e = (rng.random(150) > 0.3).astype(int)
    rows = [("FD001", i, float(x[i, 0]), float(x[i, 1]), int(t[i]), int(e[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "variant string, unit_id int, a double, b double, duration int, event int")
    return df.cache(), x, t, e


def test_concordance_against_all_pairs(units):
    df, x, t, e = units
    for risk, values in ((F.round("a", 1), np.round(x[:, 0], 1)), (F.lit(1.0), np.ones(150))):
        row = survival.concordance(df.withColumn("hazard", risk)).first()
        values = np.array([r["hazard"] for r in df.withColumn("hazard", risk).orderBy("unit_id").collect()])
        index, pairs = brute_concordance(t, e, values)
        assert row["comparable"] == pairs and row["c_index"] == pytest.approx(index)


def test_weighted_concordance_equals_repeated_rows(units):
    df, x, t, e = units
    w = np.arange(150) % 3
    row = survival.concordance(
        df.withColumn("hazard", F.col("a")), weight=(F.col("unit_id") % 3)
    ).first()
    index, _ = brute_concordance(np.repeat(t, w), np.repeat(e, w), np.repeat(x[:, 0], w))
    assert row["c_index"] == pytest.approx(index)


def efron(beta, x, t, e, penalty):
    eta = x @ beta
    value = 0.0
    for time in np.unique(t[e == 1]):
        dead = (t == time) & (e == 1)
        s0, e0, m = np.exp(eta[t >= time]).sum(), np.exp(eta[dead]).sum(), dead.sum()
        value += eta[dead].sum() - np.log(s0 - np.arange(m) / m * e0).sum()
    return value / len(t) - 0.5 * penalty * beta @ beta


def test_cox_maximises_the_efron_likelihood(units):
    df, x, t, e = units
    model = survival.fit_cox(df, ["a", "b"], penalizer=0.1)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    beta = np.array(model.beta)
    best = efron(beta, z, t, e, 0.1)
    assert model.log_likelihood / 150 - 0.05 * beta @ beta == pytest.approx(best)
    for step in ([1e-3, 0], [-1e-3, 0], [0, 1e-3], [0, -1e-3]):
        assert efron(beta + step, z, t, e, 0.1) <= best
    assert model.coefficients["a"] > 0.4 and model.coefficients["b"] < -0.1
    assert survival.concordance(model.score(df)).first()["c_index"] > 0.65


def test_constant_features_are_dropped(units):
    df = units[0].withColumn("flat", F.lit(2.0))
    assert survival.fit_cox(df, ["a", "flat"], iterations=3).features == ["a"]


@pytest.mark.parametrize("hot", [False, True])
def test_survival_rows(readings, hot):
    df = readings({u: 10 + u for u in range(1, 41)} | {90: 3})
    rows = survival.survival_rows(df, ["sensor_1"], hot=hot).collect()
    assert len(rows) == 41
    for r in rows:
        life = 3 if r["unit_id"] == 90 else 10 + r["unit_id"]
        assert r["sensor_1"] == r["duration"]
        assert r["duration"] == life if r["event"] else 1 <= r["duration"] < life
    censored = sum(1 - r["event"] for r in rows)
    assert 4 <= censored <= 22 and next(r for r in rows if r["unit_id"] == 90)["event"] == 1


def test_bootstrap(units):
    df = units[0].withColumn("hazard", F.col("a"))
    drawn = survival.bootstrap_weights(df, samples=15)
    sizes = {r["n"] for r in drawn.groupBy("sample").agg(F.sum("weight").alias("n")).collect()}
    assert sizes == {150}
    row = survival.concordance_interval(df, samples=15).first()
    assert row["ci_low"] < row["c_index"] < row["ci_high"]
    few = survival.concordance_interval(df, samples=5).first()
    assert few["ci_low"] is None and few["c_index"] == row["c_index"]
