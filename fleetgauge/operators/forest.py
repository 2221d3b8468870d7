"""Random forest of a yes-or-no label: rows are dealt to pieces of trees, and a piece grows in one task.

Bins, draws, splits and votes follow Spark ML's forest: every tree counts each row as often as a Poisson draw of
mean 1 says, every node draws its features, and a split must lower the Gini impurity. Nodes of more rows than a
task should hold are split by histograms that all tasks add up; a node below that is a piece: its rows, one byte a
feature, are sent to one task, which grows all below it by sorting (node, bin) and merges leaves that say the same. Fitted trees are a table of pieces.
They are asked by cells of row blocks and pieces; neither trees nor rows go through the driver.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fleetgauge.operators.boosting import BINS, _added, _matrix, sampled_edges
from fleetgauge.schema import SEED
from fleetgauge.session import pinned, scratch_path

_ROWS = 1 << 16  # rows of a block
_SMALL, _LARGE = 8_000, 1_000_000  # rows worth a task that deals them, and the most it gets
PIECE_ROWS = 6_000_000  # draws that a task grows a piece of
_DEALT_BYTES = 8 << 30  # bytes of rows that are dealt at a time
_GROUP_BYTES = 64 << 20  # bytes of trees that a task asks at a time
_STRIPE_ROWS = 4_000_000  # rows that one reading of the trees serves
_CELL_VOTES = 2_000_000  # votes worth a task of their own
_NONE = 1e-12  # share of a node's weight that is rounding
_NODES = "piece int, tree int, path array<int>, feature binary, cut binary, child binary, value binary, n_nodes int, gains array<double>"


_NEAR = 1 << 14  # rows whose bins stay close to the core
_HALF = 26  # bits of a count of draws; sums of both counts are exact as doubles
_PACKED = np.array([(b & 127) * (1 + ((b >> 7) << _HALF)) for b in range(256)])  # draws, and those of class 1 above
_COUNTS = _PACKED.astype(float)


class Block(NamedTuple):
    """Binned rows (row, feature) with labels 0 or 1; `key` seeds the draws of its rows."""

    key: tuple[int, int]
    x: np.ndarray
    y: np.ndarray


class Piece(NamedTuple):
    """A node of a tree whose rows meet `path`: (feature, bin, is above). `value` is set at a leaf, where `size`
    draws don't part further."""

    tree: int
    path: tuple[tuple[int, int, bool], ...]
    size: int
    value: float | None = None


class Nodes(NamedTuple):
    """Nodes by level. A row goes to `child`, or the one after it if its bin is above `cut`; a leaf is its own child."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray


def _bins(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for f, e in enumerate(edges):
        out[:, f] = np.searchsorted(e, x[:, f], side="left")
    return out


def _blocks(rows: DataFrame, edges: list[np.ndarray]) -> RDD:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(held) -> pa.RecordBatch:
            x, y = (np.concatenate(v) for v in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["x", "y"])

        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1).to_numpy(zero_copy_only=False)
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1")
                held.append((_bins(_matrix(batch.column(0)), edges), y.astype(np.uint8)))
                n += batch.num_rows
            if n >= _ROWS:
                yield block(held)
                held, n = [], 0
        if held:
            yield block(held)

    def blocks(part: int, found: Iterator) -> Iterator[Block]:
        for i, row in enumerate(found):
            yield Block((part, i), np.frombuffer(row.x, np.uint8).reshape(-1, len(edges)), np.frombuffer(row.y, np.uint8))

    return rows.mapInArrow(run, "x binary, y binary").rdd.mapPartitionsWithIndex(blocks, True)


def _below(x: np.ndarray, rows: np.ndarray, path: Sequence[tuple[int, int, bool]]) -> np.ndarray:
    """Those of `rows` that meet the path."""
    for feature, cut, above in path:
        rows = rows[(x[rows, feature] > cut) == above]
    return rows


def _drawn(block: Block, pieces: Sequence[tuple[int, Piece]], seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of the block in each piece, and how often its tree counts every row of the block."""
    tree, count, bag = None, None, None
    for at, piece in pieces:
        if piece.tree != tree:
            tree = piece.tree
            count = np.minimum(np.random.default_rng([seed, tree, *block.key]).poisson(1.0, len(block.y)), 127).astype(np.uint8)
            bag = np.flatnonzero(count)
        yield at, _below(block.x, bag, piece.path), count


def tried_features(draw: np.random.Generator, nodes: int, features: int, kept: int) -> np.ndarray:
    """`kept` different features for each node, any set as likely as any other."""
    deck, rows = np.tile(np.arange(features, dtype=np.int16), (nodes, 1)), np.arange(nodes)
    for j in range(kept if kept < features else 0):
        other = j + draw.integers(0, features - j, nodes)
        deck[rows, other], deck[:, j] = deck[:, j], deck[rows, other]
    return deck[:, :kept]


def _purity(n0, n1, weights):
    """Sum of squared class weights over the whole weight; a split gains what it raises the sum of this."""
    a, b = weights[0] * n0, weights[1] * n1
    return (a * a + b * b) / (a + b)


def grow(
    x: np.ndarray, low: np.ndarray, depth: int, deepest: int, leaf: int, weights: tuple[float, float], kept: int,
    draw: np.random.Generator,
) -> tuple[Nodes, np.ndarray]:
    """All nodes below one at `depth`, and the gain by feature. A byte of `low` is a row's label (top bit) and its count."""
    features, flat = x.shape[1], x.reshape(-1)
    base, node = np.arange(len(low)) * features, np.zeros(len(low), np.int64)
    count = (low & 127).astype(np.int64)
    upto1 = int(count[low > 127].sum())
    n0, n1 = np.array([int(count.sum()) - upto1]), np.array([upto1])
    del count
    out, gain, yes, first = [], [], [], 0
    while True:
        k = len(n0)
        whole = weights[0] * n0 + weights[1] * n1
        level = Nodes(np.zeros(k, np.int16), np.full(k, 255, np.uint8), np.arange(first, first + k, dtype=np.int32),
                      (weights[1] * n1 / np.where(whole > 0, whole, 1.0)).astype(np.float32))
        out.append(level)
        gain.append(np.zeros(k))
        yes.append(weights[1] * n1 > weights[0] * n0)
        wide = (n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * leaf) & (depth < deepest)
        nodes = np.flatnonzero(wide)
        if not len(nodes):
            break
        if len(nodes) < k:
            stay = wide[node]
            base, low, node = base[stay], low[stay], (np.cumsum(wide) - 1)[node[stay]]
        n0, n1 = n0[nodes], n1[nodes]
        tried = tried_features(draw, len(nodes), features, kept)
        best, by, cut, left0, left1 = _best_splits(flat, base, low, node, n0, n1, tried, leaf, weights)
        won = best - _purity(n0, n1, weights)
        parted = won > _NONE * (weights[0] * n0 + weights[1] * n1)
        if not parted.any():
            break
        rank = np.cumsum(parted) - 1
        to = nodes[parted]
        level.feature[to], level.cut[to] = by[parted], cut[parted]
        level.child[to] = first + k + 2 * rank[parted]
        gain[-1][to] = won[parted]
        first += k
        stay = parted[node]
        base, low, node = base[stay], low[stay], node[stay]
        node = 2 * rank[node] + (flat.take(base + by[node]) > cut[node])
        n0 = np.column_stack([left0[parted], n0[parted] - left0[parted]]).reshape(-1)
        n1 = np.column_stack([left1[parted], n1[parted] - left1[parted]]).reshape(-1)
        depth += 1
    return _pruned(out, np.concatenate(gain), np.concatenate(yes), features)


def _pruned(levels: list[Nodes], gain: np.ndarray, yes: np.ndarray, features: int) -> tuple[Nodes, np.ndarray]:
    """All nodes but pairs of leaves that say the same class, as Spark ML prunes them; and the gain by feature."""
    nodes = Nodes(*(np.concatenate(c) for c in zip(*levels)))
    starts = np.cumsum([0, *(len(level.cut) for level in levels)])
    own, child = np.arange(len(yes), dtype=np.int32), nodes.child
    for a, b in reversed(list(zip(starts, starts[1:]))):
        inner = a + np.flatnonzero(child[a:b] != own[a:b])
        left = child[inner]
        same = (child[left] == left) & (child[left + 1] == left + 1) & (yes[left] == yes[left + 1])
        child[inner[same]] = inner[same]
    alive = np.zeros(len(yes), bool)
    alive[0] = True
    for a, b in zip(starts, starts[1:]):
        left = child[a + np.flatnonzero(alive[a:b] & (child[a:b] != own[a:b]))]
        alive[left] = alive[left + 1] = True
    inner = alive & (child != own)
    gains = np.bincount(nodes.feature[inner], gain[inner], features).astype(float)
    nodes.cut[~inner] = 255
    place = (np.cumsum(alive) - 1).astype(np.int32)
    return Nodes(nodes.feature[alive], nodes.cut[alive], place[child[alive]], nodes.value[alive]), gains


def _columns(flat: np.ndarray, base: np.ndarray, node: np.ndarray, tried: np.ndarray) -> np.ndarray:
    """(tried, row): the bins of each row in the features that its node tries; a part of the rows at a time, as all
    features of a row lie together."""
    out, wanted = np.empty((tried.shape[1], len(base)), np.uint8), [f.astype(np.int64) for f in tried.T]
    for a in range(0, len(base), _NEAR):
        b = slice(a, a + _NEAR)
        for j, f in enumerate(wanted):
            out[j, b] = flat.take(base[b] + f.take(node[b]))
    return out


def _best_splits(flat, base, low, node, n0, n1, tried, leaf, weights):
    """Per node the best purity of two sides, its feature and bin, and the counts below."""
    k = len(n0)
    best, by, cut = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, np.int64)
    left0, left1 = np.zeros(k, np.int64), np.zeros(k, np.int64)
    dense = 32 * k <= len(low)  # more rows than bins of nodes: they are counted in place, else sorted
    if dense:
        code, weight = node * BINS, _COUNTS.take(low)
    else:
        kind = np.uint32 if k < 1 << 19 else np.uint64
        high = (node.astype(kind) << kind(13)) | low  # node, 5 bits of bin, label, 7 bits of count
    for f, bins in zip(tried.T, _columns(flat, base, node, tried)):
        if dense:
            total = np.bincount(code + bins, weight, BINS * k)
            cell = np.flatnonzero(total)
            upto = np.cumsum(total.take(cell).astype(np.int64))
        else:
            key = bins.astype(kind)
            key <<= kind(8)
            key |= high
            key.sort()
            cell = key >> kind(8)
            ends = np.append(np.flatnonzero(cell[1:] != cell[:-1]), len(cell) - 1)
            upto = np.cumsum(_PACKED.take((key & kind(255)).astype(np.uint8))).take(ends)
            cell = cell.take(ends).astype(np.int64)
        at = cell >> 5
        starts = np.append(0, np.flatnonzero(at[1:] != at[:-1]) + 1)
        left = upto - np.append(0, upto[starts[1:] - 1])[at]
        l1 = left >> _HALF
        l0 = (left & ((1 << _HALF) - 1)) - l1
        r0, r1 = n0[at] - l0, n1[at] - l1
        with np.errstate(divide="ignore", invalid="ignore"):
            score = _purity(l0, l1, weights) + _purity(r0, r1, weights)
        score[(l0 + l1 < leaf) | (r0 + r1 < leaf)] = -np.inf
        top = np.maximum.reduceat(score, starts)
        hit = np.flatnonzero((score == top[at]) & (top > best)[at])
        hit = hit[np.append(True, at[hit][1:] != at[hit][:-1])] if len(hit) else hit  # the lowest bin
        won = at[hit]
        best[won], by[won], cut[won], left0[won], left1[won] = score[hit], f[won], cell[hit] & 31, l0[hit], l1[hit]
    return best, by, cut, left0, left1


def steps_of(nodes: Nodes) -> np.ndarray:
    """Child, feature and bin of a node as one number, so that a step reads it at once."""
    return (nodes.child.astype(np.int64) << 24) | (nodes.feature.astype(np.int64) << 8) | nodes.cut


def walked(flat: np.ndarray, base: np.ndarray, steps: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of every row's leaf."""
    out, live, node = np.empty(len(base), np.float32), np.arange(len(base)), np.zeros(len(base), np.int64)
    while True:
        for _ in range(4):
            step = steps.take(node)
            above = flat.take(base + ((step >> 8) & 0xFFFF)) > (step & 255)
            step >>= 24
            step += above
            node = step
        done = (steps.take(node) >> 24) == node
        if done.all():
            out[live] = value.take(node)
            return out
        if 4 * np.count_nonzero(done) > len(done):
            out[live[done]] = value.take(node[done])
            live, base, node = live[~done], base[~done], node[~done]


class RandomForest(Estimator):
    """`trees` trees on the vectors in `_features`; classes are 0 and 1 and weigh `weights`. A node tries the square
    root of the number of features, rounded up; both sides of a split hold `leaf` draws at least."""

    def __init__(self, label: str, weights: tuple[float, float], trees: int, depth: int, leaf: int = 1, seed: int = SEED):
        super().__init__()
        self.label, self.weights, self.trees, self.depth, self.leaf, self.seed = label, weights, trees, depth, leaf, seed

    def _fit(self, dataset: DataFrame) -> ForestModel:
        spark = dataset.sparkSession
        weight = F.when(F.col(self.label) == 1, float(self.weights[1])).otherwise(float(self.weights[0]))
        data = dataset.select(vector_to_array("_features").alias("x"), F.col(self.label).cast("double").alias("y"), weight.alias("w"))
        n = data.count()
        if not n:
            raise ValueError("no rows to fit")
        edges = sampled_edges(data, n, self.seed)
        parts = max(min(spark.sparkContext.defaultParallelism, -(-n // _SMALL)), -(-n // _LARGE))
        blocks = _blocks(data.select("x", "y").repartition(parts), edges).persist(StorageLevel.MEMORY_AND_DISK)
        pieces, gains = self._pieces(blocks, n, len(edges))
        path, start, wave = scratch_path(spark, "forest"), 0, []
        ordered = sorted(enumerate(pieces), key=lambda p: (p[1].tree, p[0]))
        for at, piece in ordered:
            wave.append((at, piece))
            start += piece.size * (len(edges) + 1) if piece.value is None else 0
            if start > _DEALT_BYTES or at == ordered[-1][0]:
                self._grown(spark, blocks, wave, len(edges)).write.mode("append").parquet(path)
                start, wave = 0, []
                spark.sparkContext._jvm.System.gc()  # Spark removes what was dealt once the driver forgot it
        blocks.unpersist()
        for row in spark.read.schema(_NODES).parquet(path).select("tree", "gains").toLocalIterator():
            gains[row.tree] += row.gains
        return ForestModel.of(path, edges, self.trees, gains)

    def _kept(self, features: int) -> int:
        return int(np.ceil(np.sqrt(features)))

    def _pieces(self, blocks: RDD, n: int, features: int) -> tuple[list[Piece], np.ndarray]:
        """Nodes that a task can hold, or that are leaves above that size; and the gains of the splits above them."""
        done, wide = [], [Piece(t, (), n) for t in range(self.trees)]
        gains, kept, seed, round_ = np.zeros((self.trees, features)), self._kept(features), self.seed, 0
        while True:
            done += [p for p in wide if p.size <= PIECE_ROWS]
            wide = [p for p in wide if p.size > PIECE_ROWS]
            if not wide:
                return done, gains
            tried = tried_features(np.random.default_rng([seed, round_]), len(wide), features, kept)

            def sums(found: Iterator[Block], asked=tuple(enumerate(wide)), tried=tried) -> Iterator[np.ndarray]:
                out = np.zeros((len(asked), kept, 2, BINS))
                for b in found:
                    for at, rows, count in _drawn(b, asked, seed):
                        side, weight = b.y[rows] * np.int64(BINS), count[rows]
                        for j, f in enumerate(tried[at]):
                            out[at, j] += np.bincount(side + b.x[rows, f], weight, 2 * BINS).reshape(2, BINS)
                yield out

            total, old, wide = _added(blocks.mapPartitions(sums)), wide, []
            for piece, hist, mine in zip(old, total, tried):
                below = np.cumsum(hist, axis=2)
                n0, n1 = below[0, :, -1]
                l0, l1 = below[:, 0, :-1], below[:, 1, :-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = _purity(l0, l1, self.weights) + _purity(n0 - l0, n1 - l1, self.weights)
                    score[(l0 + l1 < self.leaf) | (n0 + n1 - l0 - l1 < self.leaf)] = -np.inf
                    won = score - _purity(n0, n1, self.weights)
                j, cut = np.unravel_index(np.argmax(won), won.shape)
                whole = self.weights[0] * n0 + self.weights[1] * n1
                if len(piece.path) >= self.depth or not won[j, cut] > _NONE * whole:
                    done.append(piece._replace(value=self.weights[1] * n1 / whole))
                    continue
                gains[piece.tree, mine[j]] += won[j, cut]
                left = int(l0[j, cut] + l1[j, cut])
                for above, size in ((False, left), (True, int(n0 + n1) - left)):
                    wide.append(Piece(piece.tree, (*piece.path, (int(mine[j]), int(cut), above)), size))
            round_ += 1

    def _grown(self, spark: SparkSession, blocks: RDD, wave: list[tuple[int, Piece]], features: int) -> DataFrame:
        """The nodes of the pieces; each has a task of its own."""
        seed, depth, leaf, weights, kept = self.seed, self.depth, self.leaf, self.weights, self._kept(features)
        grown = tuple((i, p) for i, (_, p) in enumerate(wave) if p.value is None)

        def dealt(found: Iterator[Block]) -> Iterator[tuple[int, bytes]]:
            for b in found:
                for at, rows, count in _drawn(b, grown, seed):
                    if len(rows):
                        yield at, ((b.y[rows] << 7) | count[rows]).tobytes() + b.x[rows].tobytes()

        def trees(slot: int, rows: Iterator) -> Iterator[tuple]:
            lows, xs = [], []
            for row in rows:
                held = np.frombuffer(row.rows, np.uint8)
                n = len(held) // (features + 1)
                lows.append(held[:n])
                xs.append(held[n:].reshape(n, features))
            at, piece = wave[slot]
            if piece.value is not None:
                nodes = Nodes(np.zeros(1, np.int16), np.full(1, 255, np.uint8), np.zeros(1, np.int32), np.full(1, piece.value, np.float32))
                gains = np.zeros(features)
            else:
                low = np.concatenate(lows or [np.zeros(0, np.uint8)])
                x = np.concatenate(xs or [np.zeros((0, features), np.uint8)])
                lows.clear()
                xs.clear()
                nodes, gains = grow(x, low, len(piece.path), depth, leaf, weights, kept, np.random.default_rng([seed, piece.tree, at]))
            yield at, piece.tree, [int(v) for step in piece.path for v in step], *(c.tobytes() for c in nodes), len(nodes.cut), gains.tolist()

        rows = spark.createDataFrame(blocks.mapPartitions(dealt), "slot int, rows binary", verifySchema=False)
        found = rows.repartitionById(len(wave), F.col("slot")).rdd.mapPartitionsWithIndex(trees)
        return spark.createDataFrame(found, _NODES, verifySchema=False)


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.read.schema(_NODES).parquet(self.model.getOrDefault("table")).write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata, model = DefaultParamsReader.loadMetadata(path, self.sparkSession), ForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(table=f"{path}/nodes")


class ForestModel(Model, MLWritable, MLReadable):
    """Fitted trees: adds `probability` (of 0 and 1), the mean of the trees' leaves, and `prediction`; the vectors are
    left out. The rows are written once, so that all their cells see the same ones."""

    table = Param(Params._dummy(), "table", "folder of the table of nodes", TypeConverters.toString)
    held = Param(Params._dummy(), "held", "edges of the bins, importances and number of trees as JSON", TypeConverters.toString)
    cacheNodeIds = Param(Params._dummy(), "cacheNodeIds", "rows are kept by node while trees grow", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(cacheNodeIds=True)

    @classmethod
    def of(cls, table: str, edges: Sequence[np.ndarray], trees: int, gains: np.ndarray) -> ForestModel:
        """`gains` by tree and feature; every tree that splits counts as one."""
        shares = (gains / np.where(gains.sum(1) > 0, gains.sum(1), 1.0)[:, None]).sum(0)
        shares = shares / shares.sum() if shares.sum() else shares
        return cls()._set(table=table, held=json.dumps({"edges": [e.tolist() for e in edges], "trees": trees, "importances": shares.tolist()}))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    @property
    def featureImportances(self) -> DenseVector:
        """Gain by feature, weighted by the rows it holds for, as shares of 1."""
        return Vectors.dense(json.loads(self.getOrDefault("held"))["importances"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, held = dataset.sparkSession, json.loads(self.getOrDefault("held"))
        edges, trees = [np.array(e) for e in held["edges"]], held["trees"]
        features, rest = len(edges), dataset.drop("_features")
        names = [*rest.columns, "_p"]

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = TaskContext.get().partitionId() << 32
            for batch in batches:
                if batch.num_rows:
                    sink, kept = pa.BufferOutputStream(), batch.select(list(range(1, batch.num_columns)))
                    with pa.ipc.new_stream(sink, kept.schema) as out:
                        out.write_batch(kept)
                    x = _bins(_matrix(batch.column(0)), edges)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([len(x)]), pa.array([x.tobytes()], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                        names=["block", "n", "x", "rest"],
                    )
                    block += 1

        given = dataset.select(vector_to_array("_features").alias("_x_of_features"), *[F.col(f"`{c}`") for c in rest.columns])
        blocks = pinned(given.mapInArrow(packed, "block long, n long, x binary, rest binary"))
        nodes = spark.read.schema(_NODES).parquet(self.getOrDefault("table"))
        votes = self._votes(blocks, nodes, features)
        summed = votes.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("grp", "votes"))).alias("votes"))

        def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, found in zip(batch.column(0), batch.column(1)):
                    total = sum(np.frombuffer(v["votes"], np.float64) for v in found.as_py())
                    for kept in pa.ipc.open_stream(row.as_buffer()):
                        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(total / trees)], names=names)

        schema = T.StructType([*rest.schema.fields, T.StructField("_p", T.DoubleType())])
        out = blocks.select("block", "rest").join(summed, "block").select("rest", "votes").mapInArrow(unpacked, schema)
        return out.withColumns({
            "probability": array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p"))),
            "prediction": (F.col("_p") > 0.5).cast("double"),
        }).drop("_p")

    def _votes(self, blocks: DataFrame, nodes: DataFrame, features: int) -> DataFrame:
        """Sums of leaf values by block and group of pieces: a task holds a group and reads a stripe of the blocks."""
        spark = blocks.sparkSession
        n = blocks.agg(F.sum("n")).first()[0] or 0
        sizes = np.array(sorted(map(tuple, nodes.select("piece", "n_nodes").collect())), np.int64)  # two numbers a piece
        stripes = max(1, -(-n // _STRIPE_ROWS))
        cells = min(2 * spark.sparkContext.defaultParallelism, 1 + n * len(sizes) // _CELL_VOTES)
        size = sizes[:, 1].cumsum() * 11
        groups = int(min(len(sizes), max(1, -(-size[-1] // _GROUP_BYTES), -(-cells // stripes))))
        grp = np.minimum((size - 1) * groups // size[-1], groups - 1)
        grouped = spark.createDataFrame([(int(p), int(g)) for p, g in zip(sizes[:, 0], grp)], "piece int, grp int")
        each = F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))
        trees = nodes.join(grouped, "piece").withColumn("stripe", each).select(
            (F.col("stripe") * groups + F.col("grp")).alias("cell"), "grp", F.lit(None).cast("long").alias("block"), "piece", "path",
            F.col("feature").alias("x"), "cut", "child", "value",
        )
        none = F.lit(None)
        asked = blocks.withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int")).withColumn(
            "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        ).select(
            (F.col("stripe") * groups + F.col("grp")).alias("cell"), "grp", "block", none.cast("int").alias("piece"), none.cast("array<int>").alias("path"),
            "x", none.cast("binary").alias("cut"), none.cast("binary").alias("child"), none.cast("binary").alias("value"),
        )

        def voted(rows: Iterator) -> Iterator[tuple[int, int, bytes]]:
            held = []
            for row in rows:
                if row.block is None:
                    path = np.array(row.path, np.int64).reshape(-1, 3)
                    tree = Nodes(np.frombuffer(row.x, np.int16), np.frombuffer(row.cut, np.uint8),
                                 np.frombuffer(row.child, np.int32), np.frombuffer(row.value, np.float32))
                    held.append(([(int(f), int(c), bool(a)) for f, c, a in path], steps_of(tree), tree.value))
                    continue
                x = np.frombuffer(row.x, np.uint8).reshape(-1, features)
                flat, total, every = x.reshape(-1), np.zeros(len(x)), np.arange(len(x))
                for path, steps, value in held:
                    mine = _below(x, every, path)
                    total[mine] += walked(flat, mine * features, steps, value)
                yield row.block, row.grp, total.tobytes()

        dealt = trees.union(asked).repartitionById(stripes * groups, F.col("cell"))
        ordered = dealt.sortWithinPartitions(F.col("block").asc_nulls_first(), "piece")
        return spark.createDataFrame(ordered.rdd.mapPartitions(voted), "block long, grp int, votes binary", verifySchema=False)
