"""SimHash near-duplicates: 64-bit fingerprints and an exact Hamming join over binary tries.

Fingerprints within `budget` differing bits agree in at least one of `budget + 1` blocks of bits.
Distinct fingerprints are therefore dealt out by block value (hot values in cells of bounded
size), and each task joins the binary tries of its cells: pairs of trie nodes go down together,
their differing bits are added up, and a pair is dropped once it exceeds the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, fresh, pair_cells, pinned, smallest_labels, spread_cells, table, tidied, whole_runs
from .components import components

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACES = ASCII_SPACE.encode()
_CELL = 2048
_PAIRS = 400_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of all shingles of `width` words, repeats included; of the whole sequence
    if it is shorter; none without words."""
    # bytes.split() without arguments splits at exactly these six white-space bytes
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(width, len(words))
    slices = map(slice, starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, slices), repeat(42)), np.uint64)


def fingerprint(text: str | None, width: int) -> int:
    """Majority of the bits of the hashes of all shingles of `width` words; 0 without words."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, name: str, width: int = 4, text: str = "text") -> DataFrame:
    """`docs` with the fingerprint as bigint `name` (replaced if there). NULL text: 0."""
    rest = [c for c in docs.columns if c != name]
    docs = docs.select(*rest)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), width) for t in batch.column(at)]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed)], names=[*rest, name])

    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def trie_pairs(values: np.ndarray, roots: list[tuple[int, int, int, int]], budget: int) -> Iterator[tuple]:
    """Index pairs of `values` (uint64, ascending within each root range) within `budget` bits.

    A trie node is a range of the sorted values with a common prefix; `roots` are pairs of ranges
    (low, high, low, high), equal for a self-join. Depth first in pieces, so memory is bounded."""
    ones = {}

    def ones_before(depth: int) -> np.ndarray:
        if depth not in ones:
            bit = (values >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        return ones[depth]

    first = np.array(roots, np.int64).reshape(-1, 4)
    stack = [(0, np.c_[first, np.zeros(len(first), np.int64)])]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > _PAIRS:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half]), (depth, nodes[half:])]
            continue
        a, b, c, d, diff = nodes.T
        single = (b - a == 1) & (d - c == 1)
        leaf = nodes[single]
        if len(leaf):
            leaf = leaf[leaf[:, 0] != leaf[:, 2]]
            near = np.bitwise_count(values[leaf[:, 0]] ^ values[leaf[:, 2]]) <= budget
            yield leaf[near, 0], leaf[near, 2]
        nodes = nodes[~single]
        if not len(nodes):
            continue
        if depth == 64:  # equal values: all of one range meet all of the other
            for a, b, c, d, _ in nodes.tolist():
                for i in range(a, b):
                    j = np.arange(max(c, i + 1) if a == c else c, d)
                    yield np.full(len(j), i), j
            continue
        before = ones_before(depth)
        a, b, c, d, diff = nodes.T
        m, n = b - (before[b] - before[a]), d - (before[d] - before[c])
        same = a == c
        children = np.concatenate([
            np.c_[a, m, c, n, diff],
            np.c_[m, b, n, d, diff],
            np.c_[a, m, n, d, diff + 1],
            np.c_[m, b, c, n, diff + 1][~same],
        ])
        keep = (children[:, 1] > children[:, 0]) & (children[:, 3] > children[:, 2]) & (children[:, 4] <= budget)
        keep &= ~((children[:, 0] == children[:, 2]) & (children[:, 1] - children[:, 0] == 1))
        stack.append((depth + 1, children[keep]))


def _cell_roots(cells: np.ndarray, parts: np.ndarray, alone: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Root pairs of rows sorted by (cell, part)."""
    edge = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (parts[1:] != parts[:-1]), True])
    roots, at = [], 0
    while at < len(edge) - 1:
        a, b = int(edge[at]), int(edge[at + 1])
        if alone[a]:
            roots.append((a, b, a, b))
        elif at + 2 < len(edge) and cells[edge[at + 1]] == cells[a]:
            roots.append((a, b, b, int(edge[at + 2])))
            at += 1
        at += 1
    return roots


def links(distinct: DataFrame, budget: int, bits: int = 64) -> DataFrame:
    """Distinct bigint column `fingerprint` to edges (low, high) whose components are those of all
    pairs within `budget` differing bits; each task gives a spanning forest, not all its pairs."""
    cuts = [round(i * bits / (budget + 1)) for i in range(budget + 2)]
    blocks = F.array(*[
        F.struct(
            F.lit(i).alias("block"),
            F.shiftrightunsigned("fingerprint", low).bitwiseAND((1 << (high - low)) - 1).alias("value"),
        )
        for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
    ])
    dealt = distinct.select("fingerprint", F.inline(blocks))
    cells = spread_cells(pair_cells(dealt, ["block", "value"], "fingerprint", _CELL), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches, "cell"):
            cell, part = rows.column("cell").to_numpy(), rows.column("part").to_numpy()
            values = rows.column("fingerprint").to_numpy().view(np.uint64)
            order = np.lexsort((values, part, cell))
            cell, part, values = cell[order], part[order], values[order]
            alone = rows.column("alone").to_numpy(zero_copy_only=False)[order]
            label = np.arange(len(values))
            for i, j in trie_pairs(values, _cell_roots(cell, part, alone), budget):
                label = _merged_labels(label, i, j)
            own = np.flatnonzero(label != np.arange(len(label)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[label[own]].view(np.int64)), pa.array(values[own].view(np.int64))], names=["low", "high"]
            )

    return cells.select("cell", "part", "alone", "fingerprint").mapInArrow(run, "low long, high long")


def _merged_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    if not len(i):
        return label
    joined = smallest_labels(label[i], label[j], len(label))
    return joined[label]


def _rooted(prints: DataFrame, budget: int) -> DataFrame:
    """Distinct `prints` (fingerprint and more) with `root`, one fingerprint per component."""
    found = components(links(prints.select("fingerprint"), budget)).withColumnRenamed("node", "fingerprint")
    return prints.join(found, "fingerprint", "left").withColumn("root", F.coalesce("component", "fingerprint")).drop("component")


def grouped(docs: DataFrame, name: str, component: str, id: str = "doc_id", width: int = 4, budget: int = 4) -> DataFrame:
    """`docs` without text, with its fingerprint `name` (bigint) and `component` (smallest id reachable by links,
    itself included). Equal fingerprints link, also those of empty and NULL texts (0). Rows with a
    NULL id take part in linking; if no other id is reachable their component is NULL."""
    work = pinned(fingerprints(docs, name, width).drop("text"))
    fp, comp = fresh(work, "fingerprint__", "component__")
    members = _rooted(pinned(work.groupBy(F.col(name).alias("fingerprint")).agg(F.min(id).alias("least"))), budget)
    smallest = members.groupBy("root").agg(F.min("least").alias(comp))
    named = members.join(smallest, "root").select(F.col("fingerprint").alias(fp), comp)
    return (
        work.join(named, work[name] == F.col(fp))
        .drop(fp)
        .withColumn(component, F.col(comp))
        .drop(comp)
    )


def deduplicated(docs: DataFrame, id: str = "doc_id", width: int = 4, budget: int = 4) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the smallest id (NULL
    last), of several with it the first by a hash of the text. A document is an id with a text: equal
    texts under one id (or none) are one document, of which one row stays; different ones are two.
    Texts without words are copies of each other. Columns and their order are those of `docs`."""
    of, digest, none, row = fresh(docs, "of__", "digest__", "none__", "row__")
    slim = docs.select(F.col(id).alias("id"), F.xxhash64("text").alias("digest"), "text")
    work = fingerprints(slim, "fingerprint", width).drop("text")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    members = _rooted(pinned(work.groupBy("fingerprint").agg(F.min(rank).alias("least"))), budget)
    kept = members.groupBy("root").agg(F.min("least").alias("least"))
    kept = kept.select(
        F.coalesce(F.col("least.id").cast("string"), F.lit("")).alias(of), F.col("least.none").alias(none), F.col("least.digest").alias(digest)
    )
    rows = docs.withColumns({of: F.coalesce(F.col(id).cast("string"), F.lit("")), none: F.col(id).isNull(), digest: F.xxhash64("text")})
    rows = rows.join(kept, [of, none, digest], "left_semi")
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(row)
    return rows.groupBy(of, none, digest).agg(first).select(f"{row}.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = grouped(docs, "bits", "component_id")
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
