"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

A shard holds a bounded number of vectors. Its points are inserted in a random order, each linked to
a diverse choice of its nearest earlier points, and back; a share of them also lives on sparser
layers above, where a search starts. Layers are flat neighbour arrays, written as a table. Query
blocks meet every shard; the shards' results are merged and ranked again in double precision.
Inner products become distances by one more coordinate that makes all norms of a shard equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned, table, whole_runs
from .vectors import matrix, one_per_id, usable

SHARD = 16_384
_BLOCK = 1024
_DEGREE = 16
_CHOICE = 48
_EXPAND = 4


def _chosen(near: np.ndarray, points: np.ndarray, gap: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none), those nearer to the point than to any
    candidate chosen before; free places go to the nearest of the rest."""
    rows, width = near.shape
    with_points = points[np.maximum(near, 0)]
    square = (with_points**2).sum(axis=2)
    between = square[:, :, None] + square[:, None, :] - 2 * np.einsum("rad,rbd->rab", with_points, with_points)
    chosen = np.zeros((rows, width), bool)
    for k in range(width):
        closest = np.where(chosen, between[:, k, :], np.inf).min(axis=1)
        chosen[:, k] = (near[:, k] >= 0) & (gap[:, k] < closest) & (chosen.sum(axis=1) < degree)
    order = np.argsort(np.where(near < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :degree]
    return np.take_along_axis(near, order, axis=1)


def layer(points: np.ndarray, degree: int) -> np.ndarray:
    """Neighbour array (n, 2 * degree; -1: none) of points in their order of insertion."""
    n = len(points)
    square = (points**2).sum(axis=1)
    forward = np.full((n, degree), -1, np.int32)
    for start in range(0, n, 256):
        stop = min(start + 256, n)
        gap = square[start:stop, None] + square[None, :stop] - 2 * points[start:stop] @ points[:stop].T
        gap[np.arange(stop)[None, :] >= np.arange(start, stop)[:, None]] = np.inf
        width = min(_CHOICE, stop)
        near = np.argpartition(gap, width - 1, axis=1)[:, :width] if stop > width else np.tile(np.arange(stop), (stop - start, 1))
        near_gap = np.take_along_axis(gap, near, axis=1)
        order = np.argsort(near_gap, axis=1, kind="stable")
        near, near_gap = np.take_along_axis(near, order, axis=1), np.take_along_axis(near_gap, order, axis=1)
        near = np.where(np.isfinite(near_gap), near, -1)
        picked = _chosen(near, points, near_gap, degree)
        forward[start:stop, : picked.shape[1]] = picked
    source, slot = np.nonzero(forward >= 0)
    target = forward[source, slot]
    edges = np.r_[np.c_[source, target], np.c_[target, source]]
    gap = square[edges[:, 0]] + square[edges[:, 1]] - 2 * np.einsum("nd,nd->n", points[edges[:, 0]], points[edges[:, 1]])
    back = np.r_[np.zeros(len(source), int), np.ones(len(source), int)]
    order = np.lexsort((gap, back, edges[:, 0]))  # own choices first, then the nearest that chose it
    edges = edges[order]
    place = np.arange(len(edges)) - np.searchsorted(edges[:, 0], edges[:, 0])
    out = np.full((n, 2 * degree), -1, np.int32)
    keep = place < 2 * degree
    out[edges[keep, 0], place[keep]] = edges[keep, 1]
    return out


def build(vectors: np.ndarray, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the bottom up: (members as rows of `vectors`, neighbour array by member place).
    `vectors` stand in their order of insertion, `ids` seed the levels."""
    norm = (vectors.astype(np.float64) ** 2).sum(axis=1)
    points = np.c_[vectors, np.sqrt(np.maximum(norm.max() - norm, 0))].astype(np.float32)
    draw = np.random.default_rng(int(ids.astype(np.uint64).sum() & np.uint64(0xFFFFFFFF))).random(len(vectors))
    level = np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(_DEGREE)).astype(int)
    layers, members = [], np.arange(len(vectors))
    while len(members):
        layers.append((members.astype(np.int32), layer(points[members], _DEGREE)))
        above = members[level[members] >= len(layers)]
        members = above if len(above) < len(members) else members[:0]
    return layers


def search(vectors: np.ndarray, layers: list, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `vectors` found for each query and their inner products, best first (-1: none)."""
    q = len(queries)
    here = np.zeros(q, np.int64)  # a row of `vectors`
    here[:] = layers[-1][0][0]
    best = np.einsum("qd,qd->q", queries, vectors[here])
    for members, near in layers[:0:-1]:
        place_of = np.full(len(vectors), -1, np.int64)
        place_of[members] = np.arange(len(members))
        moving = np.arange(q)
        while len(moving):
            around = near[place_of[here[moving]]]
            rows = members[np.maximum(around, 0)]
            score = np.einsum("qd,qkd->qk", queries[moving], vectors[rows])
            score[around < 0] = -np.inf
            top = score.argmax(axis=1)
            value = score[np.arange(len(moving)), top]
            better = value > best[moving]
            best[moving[better]] = value[better]
            here[moving[better]] = rows[np.arange(len(moving)), top][better]
            moving = moving[better]
    near = layers[0][1]
    seen = np.zeros((q, len(vectors) + 1), bool)  # the last column stands for "none"
    seen[:, -1] = True
    found = np.full((q, beam), -1, np.int64)
    score = np.full((q, beam), -np.inf, np.float32)
    done = np.zeros((q, beam), bool)
    found[:, 0], score[:, 0] = here, best
    seen[np.arange(q), here] = True
    row = np.arange(q)[:, None]
    while True:
        waiting = np.where(done | (found < 0), -np.inf, score)
        pick = np.argpartition(-waiting, _EXPAND - 1, axis=1)[:, :_EXPAND] if beam > _EXPAND else np.tile(np.arange(beam), (q, 1))
        live = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
        if not live.any():
            return found, score
        np.put_along_axis(done, pick, True, axis=1)
        around = near[np.maximum(np.take_along_axis(found, pick, axis=1), 0)]
        around = np.where(live[:, :, None], around, -1).reshape(q, -1)
        around = np.sort(around, axis=1)
        again = np.c_[np.zeros((q, 1), bool), around[:, 1:] == around[:, :-1]]
        fresh = ~again & ~seen[row, around]
        seen[row, around] = True
        value = np.full(around.shape, -np.inf, np.float32)
        i, j = np.nonzero(fresh)
        value[i, j] = np.einsum("nd,nd->n", queries[i], vectors[around[i, j]])
        both = np.c_[score, value]
        keep = np.argpartition(-both, beam - 1, axis=1)[:, :beam]
        score = np.take_along_axis(both, keep, axis=1)
        found = np.take_along_axis(np.c_[found, np.where(fresh, around, -1)], keep, axis=1)
        done = np.take_along_axis(np.c_[done, np.zeros_like(fresh)], keep, axis=1)


def _graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_runs(batches, "shard"):
        shard = rows.column("shard").to_numpy()
        edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            part = rows.slice(a, b - a)
            ids, vectors = part.column("id").to_numpy(), matrix(part.column("vector"))
            layers = build(vectors, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[a])]), pa.array([vectors.shape[1]], pa.int32()), pa.array([ids.tobytes()]),
                 pa.array([vectors.astype(np.float64).tobytes()]),
                 pa.array([[m.tobytes() for m, _ in layers]], pa.list_(pa.binary())),
                 pa.array([[n.tobytes() for _, n in layers]], pa.list_(pa.binary()))],
                names=["shard", "length", "ids", "vectors", "members", "neighbours"],
            )


def index(vectors: DataFrame, shard_rows: int = SHARD, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per shard with its vectors and layers as flat arrays, over every usable vector.

    NULL and zero vectors, vectors with NULL or non-finite components and rows with a NULL id take
    no part. Rows that share an id are one vector (the first by components). Vectors of different
    lengths are in different shards. Shards have about `shard_rows` rows."""
    rows = one_per_id(vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector")), "id", "vector")
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("length", F.size("vector"))
    rows = pinned(rows)
    shards = rows.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards"))
    rows = rows.join(shards, "length").withColumn("shard", F.xxhash64("length", F.pmod(F.xxhash64(F.lit(3), "id"), F.col("shards"))))
    dealt = rows.select("shard", "id", "vector").repartition("shard").sortWithinPartitions("shard", F.xxhash64(F.lit(5), "id"), "id")
    return dealt.mapInArrow(_graphs, "shard long, length int, ids binary, vectors binary, members array<binary>, neighbours array<binary>")


def _met(batches: Iterator[pa.RecordBatch], k: int, beam: int) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        for row in batch.to_pylist():
            if held is None or held[0] != row["shard"]:
                d = row["length"]
                ids = np.frombuffer(row["ids"], np.int64)
                exact = np.frombuffer(row["vectors"], np.float64).reshape(-1, d)
                layers = [(np.frombuffer(m, np.int32), np.frombuffer(n, np.int32).reshape(-1, 2 * _DEGREE))
                          for m, n in zip(row["members"], row["neighbours"])]
                held = row["shard"], ids, exact, exact.astype(np.float32), layers
            _, ids, exact, fast, layers = held
            asked = np.array([q["id"] for q in row["queries"]], np.int64)
            wanted = np.array([q["vector"] for q in row["queries"]], np.float64)
            width = min(beam, len(ids))
            for start in range(0, len(asked), 512):
                part = slice(start, start + 512)
                found, _ = search(fast, layers, wanted[part].astype(np.float32), width)
                score = np.einsum("qd,qkd->qk", wanted[part], exact[np.maximum(found, 0)])
                names = ids[np.maximum(found, 0)]
                score[(found < 0) | (names == asked[part][:, None])] = -np.inf
                order = np.lexsort((names, -score), axis=1)[:, :k]
                score, names = (np.take_along_axis(x, order, axis=1) for x in (score, names))
                i, j = np.nonzero(np.isfinite(score))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked[part][i]), pa.array(names[i, j]), pa.array(score[i, j])], names=["query_id", "vec_id", "score"]
                )


def nearest(
    queries: DataFrame, graphs: DataFrame, k: int = 20, beam: int = 256, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The `k` candidates with the largest inner product found for each query, its own id left out:
    query_id, rank, vec_id, score (double precision); ties go to the smaller id.

    Only usable queries are answered, by vectors of their length. `beam` trades time for recall."""
    asked = one_per_id(queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("vector")), "id", "vector")
    asked = asked.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("length", F.size("vector"))
    sizes = asked.groupBy("length").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    blocks = asked.join(sizes, "length").groupBy("length", F.pmod(F.xxhash64(F.lit(9), "id"), F.col("blocks")).alias("block"))
    blocks = blocks.agg(F.collect_list(F.struct("id", "vector")).alias("queries"))  # about _BLOCK of them
    shards = graphs.select("shard", "length").groupBy("length").agg(F.collect_set("shard").alias("shards"))
    meetings = blocks.join(shards, "length").select(F.explode("shards").alias("shard"), "block", "queries")
    joined = meetings.join(graphs, "shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _met(batches, k, beam)

    found = joined.select("shard", "length", "ids", "vectors", "members", "neighbours", "queries")
    found = found.mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where(F.col("vec_id") % 20 == 0), pinned(index(vectors)))
