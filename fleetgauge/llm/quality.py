"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, remainder, table, tidied

STATISTICS = [
    "log_words", "log_word_bytes", "distinct_words", "repeated_neighbours", "capitals",
    "marks", "runs_of_marks", "bare_marks", "digits", "sentence_ends", "log_line_words",
]
_CAPITALS = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
_DIGITS = bytes(range(48, 58))
_PLAIN = bytes([*range(33), *b".,", *range(48, 58), *range(65, 91), *range(97, 123), *range(127, 256)])


def _share(part: float, whole: float) -> float:
    """Logit of a share, smoothed by half a count so that it is always finite."""
    return float(np.log((part + 0.5) / (max(whole - part, 0) + 0.5)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of the whole text; a NULL text counts as empty."""
    raw = (text or "").encode()
    words = raw.split()
    n, size = len(words), len(raw)
    letters = size - len(raw.translate(None, _LETTERS))
    marks = raw.translate(None, _PLAIN)
    inside = sum(map(len, words))
    lines = 1 + raw.count(b"\n")
    return [
        float(np.log1p(n)),
        float(np.log((inside + 1) / (n + 1))),
        _share(len(set(words)), n),
        _share(sum(a == b for a, b in pairwise(words)), n),
        _share(size - len(raw.translate(None, _CAPITALS)), letters),
        _share(len(marks), size),
        _share(sum(a == b for a, b in pairwise(marks)), max(len(marks), 1)),
        _share(sum(len(w) == 1 and w in b"|*#-=~<>/\\+_" for w in words), n),
        _share(size - len(raw.translate(None, _DIGITS)), size),
        _share(sum(w.endswith((b".", b"!", b"?")) for w in words), n),
        float(np.log((n + 1) / lines)),
    ]


@dataclass
class Discriminant:
    """Class means, Cholesky factors of the shrunken covariances and log-determinants; `share` is the
    smoothed share of label 1, the score of every text when a class has no rows. Texts of few words
    carry little evidence: the density difference counts n / (n + `doubt`) for n words."""

    share: float
    doubt: float = 30.0
    means: np.ndarray | None = None
    inverse_factors: np.ndarray | None = None
    constants: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        z = np.einsum("kij,knj->kni", self.inverse_factors, x[None] - self.means[:, None])
        density = self.constants[:, None] - 0.5 * (z**2).sum(axis=2)
        words = np.expm1(x[:, 0])
        odds = np.log(self.share / (1 - self.share)) + (density[1] - density[0]) * words / (words + self.doubt)
        return 1 / (1 + np.exp(np.clip(-odds, -700, 700)))


def _rows(batches: Iterator[pa.RecordBatch], at: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([statistics(t.as_py()) for t in batch.column(at)]).reshape(-1, len(STATISTICS))
        rest = [c for i, c in enumerate(batch.columns) if i != at]
        yield pa.RecordBatch.from_arrays([*rest, *(pa.array(c) for c in x.T)], names=names)


def fit(docs: DataFrame, labels: DataFrame, shrink: float = 0.2, ridge: float = 0.02, doubt: float = 30.0) -> Discriminant:
    """Fit to `labels` (doc_id, label 0 or 1) of `docs` (doc_id, text), all of them.

    Class covariances are moved by `shrink` towards the pooled one, then by `ridge` towards a
    multiple of the identity. Moments are one distributed aggregate; two rows reach the driver.
    Labels that are NULL or neither 0 nor 1 are left out; repeated rows count repeatedly."""
    fields = [T.StructField(s, T.DoubleType()) for s in STATISTICS]
    x = docs.select("doc_id", "text").mapInArrow(
        partial(_rows, at=1, names=["doc_id", *STATISTICS]),
        T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *fields]),
    )
    known = labels.where("label in (0, 1)").select("doc_id", F.col("label").cast("int").alias("label"))
    d = len(STATISTICS)
    sums = [F.sum(s) for s in STATISTICS]
    crossed = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])) for i in range(d) for j in range(i, d)]
    found = {r[0]: r[1:] for r in x.join(known, "doc_id").groupBy("label").agg(F.count(F.lit(1)), *sums, *crossed).collect()}
    counts = [found[k][0] if k in found else 0 for k in (0, 1)]
    share = (counts[1] + 1) / (sum(counts) + 2)
    if min(counts) == 0:
        return Discriminant(share)
    means, scatter = [], []
    for k in (0, 1):
        n, mean = found[k][0], np.array(found[k][1 : d + 1]) / found[k][0]
        square = np.zeros((d, d))
        square[np.triu_indices(d)] = found[k][d + 1 :]
        square = square + np.triu(square, 1).T
        means.append(mean)
        scatter.append(square - n * np.outer(mean, mean))
    pooled = reduce(np.add, scatter) / sum(counts)
    scale = np.sqrt(np.diag(pooled) + 1e-6)
    factors, constants = [], []
    for k in (0, 1):
        cov = (1 - shrink) * scatter[k] / counts[k] + shrink * pooled
        cov = cov / np.outer(scale, scale)
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower) / scale)
        constants.append(-np.log(np.diag(lower)).sum())
    return Discriminant(share, doubt, np.array(means), np.array(factors), np.array(constants))


def scored(docs: DataFrame, model: Discriminant, name: str = "score", text: str = "text") -> DataFrame:
    """`docs` with the score `name` (0 to 1; a column of that name is replaced). Every row, empty
    and NULL texts too, gets one from its whole text alone."""
    rest = [c for c in docs.columns if c != name]
    docs = docs.select(*rest)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(at)]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*rest, name])

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def trained(spark, sf_dir: str) -> Discriminant:
    """Fitted to the labelled documents that are not held out."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 4) != 2)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fit(docs, labels.select("doc_id", F.col("quality").alias("label")))


def accepted(docs: DataFrame, model: Discriminant, threshold: float = 0.2) -> DataFrame:
    """The documents that score at least `threshold`, with their own columns."""
    (score,) = fresh(docs, "score__")
    return scored(docs, model, score).where(F.col(score) >= threshold).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, trained(spark, sf_dir)).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
