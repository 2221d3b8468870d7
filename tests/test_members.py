import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.functions.scalars import key_uniform
from fleetgauge.operators import drift, leaves, models, passes, permutation

RNG = np.random.default_rng(0)


@pytest.fixture(scope="module")
def rows(spark):
    x = RNG.standard_normal((600, 2))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - 0.5)))
    y = (RNG.random(600) < p).astype(int)
    out = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(out, "id long, a double, b double, label_within_x int").repartition(5)


def test_pass_weights_equal_the_column_hash(spark):
    ids = [-5, 0, 7, 3_000_000_000, 2**62]
    df = spark.createDataFrame([(i,) for i in ids], "id long").select(
        "id", *[key_uniform(9, F.col("id"), F.lit(t)).alias(f"u{t}") for t in range(6)])
    mine = passes.pass_weights([np.array(ids)], 6, 9)
    for row, got in zip(df.collect(), mine):
        assert [int(np.searchsorted(passes.POISSON, row[f"u{t}"], side="right")) for t in range(6)] == got.tolist()
    many = passes.pass_weights([np.arange(20_000)], 3)
    assert np.allclose(many.mean(0), 1, atol=0.03) and np.allclose(many.var(0), 1, atol=0.05)


@pytest.mark.parametrize("kind", ["linear", "logistic"])
def test_members_equal_fits_one_by_one(spark, rows, kind):
    fitted = passes.fit_members(rows, ["a", "b"], [F.col("id")], kind, passes=4, ridge=1e-9)
    local = rows.orderBy("id").toPandas()
    weights = passes.pass_weights([local["id"].to_numpy()], 4)
    x = np.column_stack([(local[["a", "b"]] - fitted.centre) / fitted.scale, np.ones(len(local))])
    y, scores = local["label_within_x"].to_numpy(float), []
    for t in range(4):
        beta = np.zeros(3)
        for _ in range(1 if kind == "linear" else 50):
            p = x @ beta if kind == "linear" else 1 / (1 + np.exp(-x @ beta))
            curve = weights[:, t] * (1 if kind == "linear" else p * (1 - p))
            beta = beta + np.linalg.solve(x.T @ (x * curve[:, None]), x.T @ (weights[:, t] * (y - p)))
        assert np.allclose(fitted.coefficients[:, t], beta, atol=1e-5)
        raw = x @ beta
        scores.append(np.clip(raw, 0, 1) if kind == "linear" else 1 / (1 + np.exp(-raw)))
    got = passes.add_passes(rows, fitted).orderBy("id").toPandas()
    assert set(got["n_passes"]) == {4} and list(got.columns[:4]) == rows.columns
    assert np.allclose(got["risk_mean"], np.mean(scores, 0), atol=1e-5)
    assert np.allclose(got["risk_std"], np.std(scores, 0), atol=1e-5)


def test_passes_of_missing_features_and_empty_frames(spark, rows):
    odd = rows.limit(50).unionByName(spark.createDataFrame([(900, None, None, None), (901, None, 1.0, 1)], rows.schema))
    fitted = passes.fit_members(odd, ["a", "b"], [F.col("id")], passes=3)
    assert passes.add_passes(odd, fitted).where("risk_mean IS NULL OR risk_std IS NULL").isEmpty()
    none = passes.fit_members(rows.limit(0), ["a", "b"], [F.col("id")], passes=3)
    assert {r["risk_mean"] for r in passes.add_passes(rows, none).collect()} == {0.5}
    with pytest.raises(ValueError):
        passes.fit_members(rows, ["a"], [F.col("id")], "other")


def test_leaf_quantiles_equal_weights_of_leaf_mates(spark):
    train = [(i, [i % 4, i % 7, i // 20], float((i * 37) % 23)) for i in range(60)]
    df = spark.createDataFrame(train, "id long, leaves array<long>, rul double")
    grid = leaves.target_grid(df, "rul")
    assert grid == sorted({t[2] for t in train})
    tables = leaves.leaf_tables(df, "leaves", "rul", grid)
    asked = [(0, [1, 2, 0]), (1, [3, 6, 2]), (2, [0, 99, 1]), (3, [50, 99, 70]), (4, None)]
    out = leaves.add_leaf_quantiles(spark.createDataFrame(asked, "id long, leaves array<long>"), tables, "leaves", {"low": 0.1, "mid": 0.5, "top": 1.0})
    for row in out.collect():
        given = asked[row["id"]][1] or []
        mates = [[t[2] for t in train if t[1][k] == leaf] for k, leaf in enumerate(given)]
        mates = [m for m in mates if m]
        for name, level in (("low", 0.1), ("mid", 0.5), ("top", 1.0)):
            want = next((g for g in grid if sum(sum(v <= g for v in m) / len(m) for m in mates) >= level * len(mates) - 1e-9), None) if mates else None
            assert row[name] == want


def test_quantile_forest_covers_unseen_rows(spark):
    x = RNG.uniform(0, 10, 3000)
    y = 3 * x + RNG.standard_normal(3000) * (1 + x / 4)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "a double, rul double")
    train, test = df.where("pmod(xxhash64(a), 4) > 0"), df.where("pmod(xxhash64(a), 4) = 0")
    forest = leaves.train_quantile_forest(train, ["a"], trees=20)
    assert len(forest.tables.grid) <= leaves.GRID
    out = leaves.add_quantile_interval(test, forest).toPandas()
    assert (out["rul_lower"] <= out["rul_median"]).all() and (out["rul_median"] <= out["rul_upper"]).all()
    assert 0.72 < ((out["rul"] >= out["rul_lower"]) & (out["rul"] <= out["rul_upper"])).mean() < 0.88


def test_empty_training_rows_give_no_quantiles(spark):
    df = spark.createDataFrame([], "leaves array<long>, rul double")
    tables = leaves.leaf_tables(df, "leaves", "rul", leaves.target_grid(df, "rul"))
    asked = spark.createDataFrame([([1, 2],)], "leaves array<long>")
    assert leaves.add_leaf_quantiles(asked, tables, "leaves", {"low": 0.1}).first()["low"] is None


@pytest.mark.parametrize("n", [1, 2, 97, 500])
def test_images_are_permutations(spark, n):
    df = permutation.add_index(spark.range(n).toDF("id"), [F.col("id")])
    found = permutation.permuted(df, n, 3, ["id"]).collect()
    for r in range(3):
        mine = [x for x in found if x["repeat"] == r]
        assert sorted(x["_index"] for x in mine) == sorted(x["_image"] for x in mine) == list(range(n))
        assert sorted(x["from_id"] for x in mine) == list(range(n))
    assert n < 97 or sum(x["_index"] == x["_image"] for x in found) < n / 10


def test_importance_of_a_real_and_a_noise_feature(spark, rows):
    model = models.train_logistic(rows, ["a", "b"])
    out = {r["feature"]: r for r in permutation.permutation_importance(rows, ["a", "b"], [F.col("id")], permutation.risk_of(model)).collect()}
    assert out["a"]["importance"] > 0.15 and abs(out["b"]["importance"]) < 0.03
    assert permutation.permutation_importance(rows.limit(0), ["a", "b"], [F.col("id")], permutation.risk_of(model)).count() == 0


def test_permuted_rows_are_scored_on_all_cores(spark, rows):
    """Rows from one file: their many images are scored in as many tasks as there are cores, evenly."""
    seen = []

    def score(df):
        seen.append(df)
        return df.withColumn("risk", F.col("_x")[0])

    permutation.permutation_importance(rows.coalesce(1), ["a", "b"], [F.col("id")], score).collect()
    tasks = [r["count"] for r in seen[0].where("feature <> ''").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) >= spark.sparkContext.defaultParallelism and max(tasks) < 2 * sum(tasks) / len(tasks)


def test_forest_rows_remember_their_nodes(spark, rows):
    """Without it, each pass over deep trees sends the trees to every task."""
    model = models.train_forest(rows, ["a", "b"], trees=3, depth=4)
    assert model.stages[-1].getOrDefault("cacheNodeIds")


def test_search_tries_every_setting(spark, rows):
    rows = rows.withColumns({"variant": F.lit("FD001"), "unit_id": F.col("id") % 20, "cycle": F.col("id")})
    settings = [dict(rounds=2, depth=1, step=0.1, rows=0.9, columns="1.0", leaf=1, positive_weight=w) for w in (1.0, 2.0, 4.0)]
    found = models.search_boosted(rows, ["a", "b"], settings=settings, parallelism=3)
    assert [r["positive_weight"] for r in found.results.orderBy("trial").collect()] == [1.0, 2.0, 4.0]
    scores = {r["trial"]: r["pr_auc"] for r in found.results.collect()}
    assert found.setting == settings[max(scores, key=lambda t: (scores[t], -t))]
    alone = models.search_boosted(rows, ["a", "b"], settings=settings, parallelism=1)
    assert alone.results.collect() == found.results.collect()


def test_upper_gamma_and_log_gamma(spark):
    pairs = [(a / 2, x) for a in (1, 2, 3, 5, 8, 21, 60) for x in (0.0, 0.1, 1.0, 3.0, 10.0, 29.0, 80.0)]
    df = spark.createDataFrame(pairs, "a double, x double").select("a", "x", drift.upper_gamma(F.col("a"), F.col("x")).alias("q"), drift.log_gamma(F.col("a")).alias("g"))
    for a, x, q, g in df.collect():
        assert math.isclose(g, math.lgamma(a), rel_tol=1e-10, abs_tol=1e-10)
        if a == int(a):
            want = math.exp(-x) * sum(x**k / math.factorial(k) for k in range(int(a)))
        else:
            want = math.erfc(math.sqrt(x)) + math.exp(-x) * sum(x ** (k + 0.5) / math.gamma(k + 1.5) for k in range(int(a)))
        assert math.isclose(q, want, rel_tol=1e-8, abs_tol=1e-12)


def test_category_drift_by_hand(spark):
    ref = spark.createDataFrame([("x", "u", "g")] * 30 + [("y", "u", "g")] * 10 + [(None, "u", "g")], "a string, b string, k string")
    cur = spark.createDataFrame([("x", "u", "g")] * 10 + [("y", "u", "g")] * 20 + [("z", "u", "g")] * 10, "a string, b string, k string")
    out = {r["feature"]: r for r in drift.category_drift(ref, cur, ["a", "b"], ["k"], method="chi_square").collect()}
    chi = 2 * (100 / 20) + 2 * (25 / 15) + 2 * (25 / 5)
    assert math.isclose(out["a"]["chi_square"], chi) and math.isclose(out["a"]["p_value"], math.exp(-chi / 2), rel_tol=1e-9)
    js = sum(s * math.log2(s / m) / 2 for p, q in ((0.75, 0.25), (0.25, 0.5), (0, 0.25)) for s, m in ((p, (p + q) / 2), (q, (p + q) / 2)) if s)
    assert math.isclose(out["a"]["jensen_shannon"], math.sqrt(js)) and out["a"]["drifted"] and not out["b"]["drifted"]
    assert (out["b"]["p_value"], out["b"]["jensen_shannon"]) == (1.0, 0.0)
    alone = drift.category_drift(ref, cur.limit(0), ["a"], method="jensen_shannon").first()
    assert alone["p_value"] is None and alone["drifted"] is False


def test_newton_steps_read_the_rows_once(spark):
    rows = spark.range(4000).select("id", F.sin("id").alias("a"), (F.sin(F.col("id") * 1.7) > 0.2).cast("int").alias("label_within_x"))
    read = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda i: (read.add(1), i)[1], "long")
    passes.fit_members(rows, ["a"], [seen("id")], passes=4, steps=4)
    assert read.value == 4000
    none = passes.fit_members(rows.where("id < 0"), ["a"], [F.col("id")], passes=4)
    assert not none.coefficients.any()


def test_leaf_tables_read_their_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([([i % 3, i % 2], float(i % 4)) for i in range(24)], "leaves array<bigint>, rul double")
    tables = leaves.leaf_tables(rows.mapInArrow(counted, rows.schema), "leaves", "rul", [0.0, 1.0, 2.0, 3.0])
    assert seen.value == 24
    assert [list(x) for x in tables.leaves] == [[0, 1, 2], [0, 1]]
    assert tables.shares[1].tolist() == [[0.5, 0.5, 1.0, 1.0], [0.0, 0.5, 0.5, 1.0]]
