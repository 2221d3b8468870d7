import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import bidiagonal, whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def factor(x):
    r = np.linalg.qr(x - x.mean(0), mode="r")
    return np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])


@pytest.mark.parametrize("kind", ["plain", "signs", "integers", "graded", "copies", "few", "equal"])
def test_singular_values_and_vectors(kind):
    draw = np.random.default_rng(len(kind))
    x = draw.standard_normal((60, 20))
    x = {"plain": x, "signs": np.sign(x), "integers": np.floor(3 * x), "graded": x * np.logspace(0, -9, 20),
         "copies": np.repeat(x[:, :10], 2, axis=1), "few": x[:6], "equal": np.tile(np.eye(20), (3, 1))}[kind]
    r = factor(x)
    values, w = bidiagonal.right_vectors(r, 20)
    exact = np.linalg.svd(r, compute_uv=False)
    assert len(values) == (exact > exact[0] * 20 * np.finfo(float).eps).sum()
    assert np.allclose(values, exact[: len(values)] ** 2, rtol=1e-10, atol=0)
    assert np.abs(w.T @ w - np.eye(len(values))).max() < 1e-10
    assert np.abs(r.T @ (r @ w) - w * values).max() < 1e-12 * exact[0] ** 2
    assert (w[np.abs(w).argmax(0), np.arange(len(values))] > 0).all()


def test_small_values_keep_their_digits():
    """Products would lose a value of 1e-9 of the largest's size altogether."""
    diagonal, above = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-2, 1e-5, 1e-8])
    values = bidiagonal.squared_values(diagonal, above)
    assert np.isclose(np.sqrt(values).prod(), diagonal.prod(), rtol=1e-13)  # the determinant
    assert np.isclose(np.sqrt(values[-1]), 1e-9, rtol=1e-3)


def brute(rows, top=8):
    """By exact integers and the covariance itself."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [[n * c - s for c, s in zip(row, sums)] for row in x]
    y = np.array(far, float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return {i: (n, sum(c * c for c in row)) for (i, _), row in zip(kept, far)}, y, values, vectors


def check_against(rows, out, top=8):
    exact, y, values, vectors = brute(rows, top)
    assert len(out) == len(exact) * top
    assert {r["vec_id"]: (r["n"], r["deviation"]) for r in out} == exact
    ids = list(exact)
    for c in range(1, top + 1):
        got = {r["vec_id"]: r for r in out if r["component"] == c}
        mine = np.array([got[i]["whitened"] for i in ids])
        want = y @ vectors[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
        assert np.isclose(got[ids[0]]["explained"], values[c - 1] / values.sum(), rtol=1e-10)
        assert 0 <= got[ids[0]]["identity_error"] < 1e-9


def test_equals_the_eigenvectors_of_the_covariance(spark):
    draw = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate((draw.standard_normal((700, 12)) * np.arange(1, 13) / 40).tolist())]
    rows += [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] * 12), (1004, [0.0] * 12)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(70)  # a tree of three levels
    df = df.withColumn("part", F.lit("clash")).withColumn("n", F.lit("clash"))
    check_against(rows, whitening.whitened(df, whitening.fit(df)).collect())


def test_given_table(spark):
    out = whitening.query(spark, "/root/testdata/sf0.01").collect()
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_against(rows, out)


def test_repeated_rows_null_ids_and_ragged_vectors(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (4, [1.0]), (5, []), (6, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = whitening.whitened(df, whitening.fit(df)).collect()
    assert [r["vec_id"] for r in out].count(1) == 2 and len(out) == 3  # three rows, one direction
    assert {r["n"] for r in out} == {3} and {r["explained"] for r in out} == {1.0}
    # two vectors on a line: whitened values -1/sqrt(2), -1/sqrt(2), sqrt(2), either sign
    assert np.allclose(sorted(abs(r["whitened"]) for r in out), [0.5**0.5, 0.5**0.5, 2**0.5])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_any_variance_there_are_no_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert whitening.whitened(df, whitening.fit(df)).collect() == []


def test_deviations_are_exact_or_null():
    x = np.array([[100_001, 99_000], [100_000, 100_000]])
    n = 3_000_000
    sums = [100_000 * n + 7, 100_000 * n - 11]
    want = [(n - 7) ** 2 + (n * 1000 - 11) ** 2, 7**2 + 11**2]
    assert whitening.deviations(x, n, sums) == [want[0] if want[0] < 2**63 else None, want[1]]
    n, sums = 2**50, [100_000 * 2**50, 100_000 * 2**50 - 1]
    assert whitening.deviations(x, n, sums) == [None, 1]
