"""Random forest: Spark ML's trees where nothing is drawn, whole pieces, and scores that many cells add up."""

import json

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fleetgauge.operators import boosting, forest, models

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def values():
    draw = np.random.default_rng(11)
    x = np.column_stack([draw.integers(0, 20, 4000) / 4.0, draw.normal(size=4000), draw.integers(0, 2, 4000), draw.normal(size=4000)])
    return x, (x[:, 0] - 2.0 * (x[:, 1] > 0.3) * x[:, 2] + draw.normal(size=4000) > 2).astype(int)


@pytest.fixture(scope="module")
def rows(spark, values):
    data = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(*values))]
    return spark.createDataFrame(data, "id int, a double, b double, c double, d double, label_within_x int").repartition(5).cache()


@pytest.fixture(scope="module")
def vectors(rows):
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows).cache()


def _risks(model, vectors):
    return np.array([r[1][1] for r in model.transform(vectors).select("id", "probability").orderBy("id").collect()])


@pytest.mark.parametrize("depth,leaf,weights", [(6, 1, (1.0, 1.0)), (30, 2, (1.5, 0.75))])
def test_tree_equals_spark_ml_without_draws(vectors, values, depth, leaf, weights):
    x, y = values
    edges = [boosting.edges_of(c, np.array(weights)[y]) for c in x.T]
    binned = forest._bins(x, edges)
    low = ((y << 7) | 1).astype(np.uint8)
    tree, gains = forest.grow(binned, low, 0, depth, leaf, weights, 4, np.random.default_rng(0))
    ours = forest.walked(binned.reshape(-1), np.arange(len(y)) * 4, forest.steps_of(tree), tree.value)
    model = DecisionTreeClassifier(featuresCol="_features", labelCol="label_within_x", weightCol="w", maxDepth=depth, minInstancesPerNode=leaf).fit(
        vectors.withColumn("w", F.when(F.col("label_within_x") == 1, weights[1]).otherwise(weights[0])))
    theirs = _risks(model, vectors)
    assert (np.abs(ours - theirs) < 1e-6).mean() > 0.99  # splits of equal gain may differ
    assert abs(len(tree.cut) - model.numNodes) <= 0.01 * model.numNodes
    assert np.allclose(gains / gains.sum(), model.featureImportances.toArray(), atol=0.01)


def test_forest_scores_like_spark_ml(rows, vectors):
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    fit, held = rows.where(half), rows.where(~half)
    judge = models.AveragePrecisionEvaluator()
    ours = models.train_forest(fit, FEATURES, trees=40)
    weighted = vectors.where(half).withColumn("w", models.balanced_weight(fit))
    theirs = RandomForestClassifier(featuresCol="_features", labelCol="label_within_x", weightCol="w", numTrees=40, maxDepth=30,
                                    minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=3).fit(weighted)
    a, b = judge.evaluate(models.score_risk(ours, held, FEATURES)), judge.evaluate(theirs.transform(vectors.where(~half)))
    assert abs(a - b) < 0.01
    mine = dict(models.importances(ours, FEATURES))
    assert np.allclose([mine[f] for f in FEATURES], theirs.featureImportances.toArray(), atol=0.03)


def test_rows_of_a_large_node_are_split_by_all_tasks(rows, vectors, monkeypatch):
    """Every row meets one piece of each tree, no piece is larger than a task may hold, and the forest is as good."""
    judge, whole = models.AveragePrecisionEvaluator(), models.train_forest(rows, FEATURES, trees=12).stages[-1]
    monkeypatch.setattr(forest, "PIECE_ROWS", 700)
    sizes, grow = [], forest.RandomForest._grown
    monkeypatch.setattr(forest.RandomForest, "_grown", lambda self, spark, blocks, wave, features: (
        sizes.extend(p.size for _, p in wave if p.value is None), grow(self, spark, blocks, wave, features))[1])
    monkeypatch.setattr(forest, "_DEALT_BYTES", 20_000)  # several waves
    cut = models.train_forest(rows, FEATURES, trees=12).stages[-1]
    assert len(sizes) > 5 * 12 and max(sizes) <= 700
    table = rows.sparkSession.read.parquet(cut.getOrDefault("table")).select("tree", "path").collect()
    x = forest._bins(np.array(rows.select(*FEATURES).collect()), [np.array(e) for e in json.loads(cut.getOrDefault("held"))["edges"]])
    met = np.zeros((12, len(x)), int)
    for r in table:
        path = [(f, c, bool(a)) for f, c, a in np.array(r.path, int).reshape(-1, 3)]
        met[r.tree, forest._below(x, np.arange(len(x)), path)] += 1
    assert (met == 1).all()
    assert abs(judge.evaluate(cut.transform(vectors)) - judge.evaluate(whole.transform(vectors))) < 0.01
    assert np.allclose(cut.featureImportances.toArray(), whole.featureImportances.toArray(), atol=0.05)


def test_cells_add_up_to_the_same_scores_and_a_saved_forest_gives_them(rows, vectors, monkeypatch, tmp_path):
    model = models.train_forest(rows, FEATURES, trees=9, depth=8)
    first = _risks(model.stages[-1], vectors)
    monkeypatch.setattr(forest, "_GROUP_BYTES", 2_000)
    monkeypatch.setattr(forest, "_STRIPE_ROWS", 1_000)
    assert np.allclose(_risks(model.stages[-1], vectors), first, atol=1e-12)
    models.save_model(model, str(tmp_path / "m"))
    assert np.allclose(_risks(models.load_model(str(tmp_path / "m")).stages[-1], vectors), first, atol=1e-12)
    assert models.score_risk(model, rows.limit(0), FEATURES).count() == 0


def test_rows_reach_tasks_once_for_all_levels_of_a_tree(rows, spark):
    """Spark ML's forest needs passes over all rows for every level of its deep trees."""
    spark.sparkContext.setJobGroup("forest", "forest")
    try:
        models.train_forest(rows, FEATURES, trees=30)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("forest")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 16
    assert forest.PIECE_ROWS >= rows.count()


def test_one_class_and_wrong_labels(rows):
    same = models.train_forest(rows.withColumn("label_within_x", F.lit(0)), FEATURES, trees=3)
    assert models.score_risk(same, rows, FEATURES).agg(F.max("risk")).first()[0] == 0
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        forest.RandomForest("label_within_x", (1.0, 1.0), 2, 3).fit(
            VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows.withColumn("label_within_x", F.lit(2))))
