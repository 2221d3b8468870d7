import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def _held_out(rows, spark, column):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_on_held_out_labels(spark):
    rows = quality.query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    pairs = _held_out(rows, spark, "quality")
    assert np.mean([a == b for a, b in pairs]) > 0.98


def test_toxicity_on_held_out_labels(spark):
    rows = toxicity.query(spark, SF).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    pairs = _held_out(rows, spark, "toxic")
    toxic = [a for a, b in pairs if b == 1]
    assert np.mean(toxic) > 0.8
    assert np.mean([a for a, b in pairs if b == 0]) < 0.01


def test_discriminant_equals_direct_densities(spark):
    rng = np.random.default_rng(1)
    words = ["ab", "cde", "fghi.", "JKL", "m!", "nop"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 60))) for _ in range(80)]
    labels = rng.integers(0, 2, 80).tolist()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = spark.createDataFrame(list(enumerate(labels)), "doc_id long, label int")
    model = quality.fit(docs, known, doubt=0.0)
    x = np.array([quality.statistics(t) for t in texts])
    y = np.array(labels)
    scatter = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(s * (y == k).sum() for k, s in enumerate(scatter)) / len(y)
    scale = np.sqrt(np.diag(pooled) + 1e-6)
    logs = []
    for k in (0, 1):
        cov = (0.8 * scatter[k] + 0.2 * pooled) / np.outer(scale, scale)
        cov = 0.98 * cov + 0.02 * np.trace(cov) / len(cov) * np.eye(len(cov))
        z = (x - x[y == k].mean(axis=0)) / scale
        logs.append(-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(cov), z))
    prior = (y.sum() + 1) / (len(y) + 2)
    expected = 1 / (1 + np.exp(-(np.log(prior / (1 - prior)) + logs[1] - logs[0])))
    assert np.allclose(model.score(x), expected, atol=1e-6)


@pytest.fixture
def odd(spark):
    long = "word " * 20_000
    rows = [(1, None, 1), (2, "", 2), (2, "", 2), (None, "plain words here.", 3), (4, long, 4), (5, "\n \t", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, score int")


def test_odd_rows_get_scores(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    assert quality.fit(odd, none).means is None
    scores = [r.score for r in quality.scored(odd, quality.fit(odd, none)).collect()]
    assert scores == [0.5] * 6
    one = spark.createDataFrame([(1, 1), (2, None), (4, 1)], "doc_id long, label int")
    assert {r.score for r in quality.scored(odd, quality.fit(odd, one)).collect()} == {0.75}
    assert quality.scored(odd.limit(0), quality.fit(odd, none)).count() == 0
    empty = spark.createDataFrame([], "label int, text string")
    model = toxicity.fit(empty, empty)
    assert [r.score for r in toxicity.scored(odd, model).collect()] == [0.5] * 6
    labelled = odd.select(F.lit(1).alias("label"), "text")
    assert toxicity.scored(odd, toxicity.fit(labelled, labelled)).columns == odd.columns


def test_kneser_ney_parts(spark):
    rows = [(0, "a b a c"), (0, "a b"), (1, "a d d")]
    tables = toxicity.count_tables(spark.createDataFrame(rows, "label int, text string"))
    b = {w: toxicity._BUCKET[w.encode()] for w in "abcd"}
    assert tables.count[0][b["a"]] == 3 and tables.count[1][b["a"]] == 1  # a is followed by b, c, b and d
    assert tables.kinds[0][b["a"]] == 2 and tables.kinds[1][b["d"]] == 1
    assert np.isclose(tables.single.sum(axis=1), 1, atol=1e-3).all()
    words = np.array([b["d"]])
    assert tables.difference(words, np.array([b["a"]]))[0] > 1


def test_accepted_keeps_columns(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    kept = quality.accepted(odd, quality.fit(odd, none), 0.2)
    assert kept.columns == odd.columns and kept.count() == 6
