"""Embedding near-duplicates by randomised-rotation binary codes (RaBitQ; Gao and Long, 2024).

A unit vector o is rotated at random and kept as the signs of its coordinates, x, with the stored
factor <x, o>. For another unit vector q, <x, q> / <x, o> estimates <o, q> without bias, with an
error of about sqrt(1 / <x, o>^2 - 1) / sqrt(D - 1). A pair whose estimate plus `deviations` such
errors stays below the threshold is settled; only the others are computed again in double precision.

Vectors of a label meet in cells of two parts of bounded size; a cell gives the number of links of
each vector and a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pair_cells, pinned, smallest_labels, spread_cells, table, whole_runs
from .components import components
from .vectors import matrix, one_per_id, usable

_PART = 2048
_STRIP = 512


@lru_cache(8)
def rotation(d: int) -> np.ndarray:
    """A fixed random rotation of at least 64 dimensions (shorter vectors are padded)."""
    size = max(64, d)
    q, r = np.linalg.qr(np.random.default_rng(20240517).standard_normal((size, size)))
    return (q * np.sign(np.diag(r)))[:d].astype(np.float32)


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `code` (packed signs) and `factor` to rows with a column `vector` of usable vectors."""
    for batch in batches:
        lengths = np.diff(batch.column("vector").offsets.to_numpy())
        codes: list = [None] * batch.num_rows
        factors = np.zeros(batch.num_rows)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            unit = _unit(matrix(batch.column("vector").take(pa.array(at))))
            turned = unit.astype(np.float32) @ rotation(int(d))
            packed = np.packbits(turned > 0, axis=1)
            factors[at] = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
            for i, code in zip(at.tolist(), packed):
                codes[i] = code.tobytes()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(codes, pa.binary()), pa.array(factors)], names=[*batch.schema.names, "code", "factor"]
        )


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # no overflow in the norm
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def cell_links(a: slice, b: slice, unit: np.ndarray, signs: np.ndarray, factor: np.ndarray, threshold: float, deviations: float):
    """Index pairs (i in a, j in b; i < j if a is b) with cosine of at least `threshold`."""
    size = signs.shape[1]
    spread = np.sqrt(np.maximum(1 / factor**2 - 1, 0) / max(size - 1, 1))
    least = (threshold - deviations * spread) * factor  # of <x, q>
    turned = (unit[b].astype(np.float32) @ rotation(unit.shape[1])).T
    found = []
    for start in range(a.start, a.stop, _STRIP):
        rows = slice(start, min(start + _STRIP, a.stop))
        estimate = signs[rows] @ turned
        i, j = np.nonzero(estimate >= least[rows, None])
        i, j = i + start, j + b.start
        if a == b:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("nd,nd->n", unit[i], unit[j]) >= threshold
        found.append((i[exact], j[exact]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _linked(batches: Iterator[pa.RecordBatch], threshold: float, deviations: float) -> Iterator[pa.RecordBatch]:
    for rows in whole_runs(batches, "cell"):
        cell, part = rows.column("cell").to_numpy(), rows.column("part").to_numpy()
        alone, ids = rows.column("alone").to_numpy(zero_copy_only=False), rows.column("id").to_numpy()
        edge = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]), True])
        at = 0
        while at < len(edge) - 1:
            start, middle = int(edge[at]), int(edge[at + 1])
            at += 1
            stop = middle
            if not alone[start]:
                if at == len(edge) - 1 or cell[middle] != cell[start]:
                    continue
                stop = int(edge[at + 1])
                at += 1
            here = rows.slice(start, stop - start)
            unit = _unit(matrix(here.column("vector")))
            bits = np.frombuffer(b"".join(here.column("code").to_pylist()), np.uint8).reshape(stop - start, -1)
            size = rotation(unit.shape[1]).shape[1]
            signs = (np.unpackbits(bits, axis=1)[:, :size].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
            first = slice(0, middle - start)
            second = first if alone[start] else slice(middle - start, stop - start)
            i, j = cell_links(first, second, unit, signs, here.column("factor").to_numpy(), threshold, deviations)
            count = np.bincount(np.r_[i, j], minlength=stop - start)
            label = smallest_labels(i, j, stop - start)
            named = ids[start:stop]
            have, own = np.flatnonzero(count), np.flatnonzero(label != np.arange(stop - start))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[named[have], named[label[own]]]), pa.array(np.r_[count[have], named[own]]),
                 pa.array(np.r_[np.zeros(len(have), bool), np.ones(len(own), bool)])],
                names=["a", "b", "edge"],
            )


def deduplicated(
    vectors: DataFrame, threshold: float = 0.93, deviations: float = 5.0,
    id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """Per vector: id, n_links, component_id (smallest id reachable by links) and kept.

    Vectors link if their labels are equal and not NULL, their lengths are equal, and their cosine
    in double precision reaches `threshold`. NULL and zero vectors, vectors with NULL or
    non-finite components and rows with a NULL id link with nothing. Rows that share an id are one
    vector (the first by label and components). `deviations` is the confidence of the code bounds:
    a pair is missed with a probability of about 3e-7 at 5."""
    rows = pinned(one_per_id(vectors.select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")), "id", "label", "vector"))
    ready = rows.where(F.col("label").isNotNull() & F.col("id").isNotNull() & usable(F.col("vector")))
    ready = ready.withColumn("length", F.size("vector"))
    schema = f"id long, label {dict(ready.dtypes)['label']}, vector {dict(ready.dtypes)['vector']}, length int, code binary, factor double"
    coded = ready.mapInArrow(encode, schema)
    cells = spread_cells(pair_cells(coded, ["label", "length"], "id", _PART), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _linked(batches, threshold, deviations)

    found = pinned(cells.select("cell", "part", "alone", "id", "vector", "code", "factor").mapInArrow(run, "a long, b long, edge boolean"))
    counts = found.where("not edge").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("n"))
    groups = components(found.where("edge").select(F.col("a").alias("low"), F.col("b").alias("high")))
    out = rows.select("id").join(counts, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "embeddings"))
