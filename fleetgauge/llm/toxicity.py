"""Toxicity: class-conditional Kneser-Ney models of word pairs.

P(w | v) of a class discounts its pair counts and backs off to the class's own continuation
counts, which back off to the continuation counts of both classes together, then to a uniform
floor of one unknown word. A word's difference is that of the two classes' log-likelihoods, bounded
by the difference of its continuation probabilities, so that a passage copied within one class
proves nothing by itself. A text is judged by its mean difference per word and by what exceeds
`_STRONG` per word; a logistic curve fitted on labelled texts that gave no counts turns these into
a score.

Words are 64-bit hashes, and so are the keys by which texts ask for pairs. All labelled pairs,
singletons too, are counted in tables that grow with the corpus and never reach the driver. Texts
are taken in chunks: a chunk asks once for each of its words and pairs, as sorted keys cut into
buckets; the task that holds a bucket's part of the tables answers all chunks, and the answers meet
the chunk's words again. So a pair costs a few bytes of shuffle, and no row of its own. Texts are
measured in slices one after another, of which only one has its questions on disk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, pinned, remainder, removed, table, tidied

_START = 0  # stands before the first word of a text
_DISCOUNT = 0.75
_STRONG = 3.0
#: Bytes of text in a chunk, and in a slice of the texts; there are at most `_SLICES` slices.
_CHUNK = 8 << 20
_SLICE = 32 << 20
_SLICES = 8
#: About so many pairs of the tables make a bucket; there are 2**_LEAST_BITS buckets at least.
_BUCKET_ROWS = 500_000
_LEAST_BITS = 6
#: Rows of a chunk: its texts, their numbers of words, the words by their place among the distinct words, these
#: themselves; then what it asks for, word by word and pair by pair. Tables have rows of the last two kinds.
_OF, _SIZES, _PLACES, _KNOWN, _WORD, _PAIR = range(6)
_ROWS = "chunk long, part int, bucket int, keys binary, numbers binary"
_TABLE = -1  # the chunk of a table's rows
_MARKS = bytes.maketrans(b".,;:!?\"'()[]{}|*#%&$-_/\\", b" " * 24)


class _Hashes(dict):
    """Bounded cache from word to its signed 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h = h - (1 << 64) if h >> 63 else h
        return h


_BUCKET = _Hashes()


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in lower case without marks, and the number of words of each text."""
    flat: list[int] = []
    sizes = []
    for text in texts:
        words = (text or "").lower().encode().translate(_MARKS).split()
        flat.extend(map(_BUCKET.__getitem__, words))
        sizes.append(len(words))
    return np.array(flat, np.int64), np.array(sizes, np.int64)


def _before(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.r_[_START, words[:-1]] if len(words) else words
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = _START
    return before


def _pair_keys(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """One mixed 64-bit number for each pair of words."""
    key = first.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ word.view(np.uint64)
    key = (key ^ key >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return key ^ key >> np.uint64(32)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (of, first, word) with their number `n` from (of, text) rows, batch by batch."""
    for batch in batches:
        words, sizes = _words(batch.column(1).to_pylist())
        of, before = np.repeat(batch.column(0).to_numpy(), sizes), _before(words, sizes)
        order = np.lexsort((words, before, of))
        of, before, words = of[order], before[order], words[order]
        new = np.ones(len(words), bool)
        new[1:] = (of[1:] != of[:-1]) | (before[1:] != before[:-1]) | (words[1:] != words[:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.r_[at, len(words)])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (of[at], before[at], words[at], n)], names=["of", "first", "word", "n"])


def _paired(rows: DataFrame) -> DataFrame:
    return rows.mapInArrow(_pairs, "of long, first long, word long, n long")


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers as bytes: all their first bytes, then all second ones, and so on, compressed."""
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _loosed(raw: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[8:], n * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def _squeezed_keys(keys: np.ndarray) -> bytes:
    return _squeezed(np.diff(keys, prepend=np.uint64(0)))


def _loosed_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_loosed(raw, np.uint64), dtype=np.uint64)


def _buckets(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted `keys` with the same upper bits."""
    upper = (keys >> np.uint64(64 - bits)).astype(np.int64)
    start = np.flatnonzero(np.r_[True, upper[1:] != upper[:-1]][: len(keys)])
    for a, b in zip(start, np.r_[start[1:], len(keys)]):
        yield int(upper[a]), slice(int(a), int(b))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", "part", "bucket", "keys", "numbers"])


def _stored(batches: Iterator[pa.RecordBatch], part: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A table's rows by bucket: one or two columns of keys, then numbers."""
    named = 2 if part == _PAIR else 1
    held: list[pa.RecordBatch] = []

    def rows() -> pa.RecordBatch:
        columns = [c.to_numpy() for c in pa.Table.from_batches(held).columns]
        keys = _pair_keys(*columns[:2]) if named == 2 else columns[0].view(np.uint64)
        order = np.argsort(keys)
        keys, numbers = keys[order], np.array(columns[named:], float)[:, order]
        held.clear()
        return _batch([(_TABLE, part, b, _squeezed_keys(keys[of]), _squeezed(numbers[:, of].ravel())) for b, of in _buckets(keys, bits)])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= 1 << 19:
            yield rows()
    if held:
        yield rows()


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; faster than `np.unique`, which hashes them."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]


def _with_start(known: np.ndarray) -> np.ndarray:
    """Sorted distinct words with `_START`, the least of all, before them."""
    return known if known[0] == _START else np.r_[np.uint64(_START), known]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[str | None]]]:
    """(of, text) rows, of each `of` only one, in pieces of about `_CHUNK` bytes."""
    batch = batch.take(pa.array(np.unique(batch.column(0).to_numpy(), return_index=True)[1]))
    of, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
    piece = np.cumsum([len(t or "") for t in texts]) // _CHUNK
    cuts = np.r_[0, np.flatnonzero(piece[1:] != piece[:-1]) + 1, len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield of[a:b], texts[a:b]


def _asked(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of each chunk of the (of, text) rows: its texts in words, and what it asks for."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for of, texts in _chunks(batch):
            words, sizes = _words(texts)
            if not len(words):
                continue
            known, places = np.unique(words.view(np.uint64), return_inverse=True)
            own = {
                _OF: _squeezed(of[sizes > 0]), _SIZES: _squeezed(sizes[sizes > 0]),
                _PLACES: _squeezed(places.astype(np.int32)), _KNOWN: _squeezed_keys(known),
            }
            rows = [(chunk, part, -1, held, None) for part, held in own.items()]
            asks = {_WORD: _with_start(known), _PAIR: _distinct(_pair_keys(_before(words, sizes), words))}
            rows += [(chunk, part, b, _squeezed_keys(keys[at]), None) for part, keys in asks.items() for b, at in _buckets(keys, bits)]
            yield _batch(rows)
            chunk += 1


def _whole(held: list[tuple[bytes, bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their `width` numbers from the rows of a table's bucket."""
    keys = [np.zeros(0, np.uint64), *(_loosed_keys(raw) for raw, _ in held)]
    numbers = [np.zeros((width, 0)), *(_loosed(raw, float).reshape(width, -1) for _, raw in held)]
    if len(held) == 1:
        return keys[1], numbers[1]
    keys, numbers = np.concatenate(keys), np.concatenate(numbers, axis=1)
    order = np.argsort(keys)
    return keys[order], numbers[:, order]


def _merged(batches: Iterator[pa.RecordBatch], widths: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """One row for each bucket and part, from table rows sorted by these."""
    now, held = None, []

    def row() -> pa.RecordBatch:
        keys, numbers = _whole(held, widths[now[1]])
        return _batch([(_TABLE, now[1], now[0], _squeezed_keys(keys), _squeezed(numbers.ravel()))])

    for batch in batches:
        for part, bucket, raw, numbers in zip(*(batch.column(c).to_pylist() for c in ("part", "bucket", "keys", "numbers"))):
            if now != (bucket, part) and held:
                yield row()
                held = []
            now = (bucket, part)
            held.append((raw, numbers))
    if held:
        yield row()


def _answered(batches: Iterator[pa.RecordBatch], missing: dict[int, list[float]]) -> Iterator[pa.RecordBatch]:
    """Numbers of the keys that chunks ask for, in their order; `missing`: those of a key that no table
    has. Rows are sorted by bucket and part, the table's before the others."""
    now, held = None, []
    for batch in batches:
        rows = []
        for chunk, part, bucket, raw, numbers in zip(*(c.to_pylist() for c in batch.columns)):
            if now != (bucket, part):
                now, held, keys = (bucket, part), [], None
            if chunk == _TABLE:
                held.append((raw, numbers))
                continue
            if keys is None:
                keys, found = _whole(held, len(missing[part]))
            asked = _loosed_keys(raw)
            at = np.searchsorted(keys, asked)
            hit = np.flatnonzero(np.r_[keys, np.uint64(0)][at] == asked)
            hit = hit[at[hit] < len(keys)]
            out = np.repeat(np.array(missing[part])[:, None], len(asked), axis=1)
            out[:, hit] = found[:, at[hit]]
            rows.append((chunk, part, bucket, None, _squeezed(out.ravel())))
        yield _batch(rows)


def _differences(first: np.ndarray, word: np.ndarray, words: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """`Tables.differences` of pairs: places of their first words and of their words in the numbers
    `words`, and numbers of their own."""
    alone = np.log(words[5]) - np.log(words[4])
    logs = []
    for k in (0, 1):
        count, kinds, single = words[k], words[2 + k], words[4 + k]
        some = np.maximum(count, 1)
        back = np.where(count > 0, np.minimum(1, _DISCOUNT * kinds / some), 1)
        logs.append(np.log(np.maximum(pair[k] - _DISCOUNT, 0) / some[first] + back[first] * single[word]))
    both, alone = logs[1] - logs[0], alone[word]
    return np.where(both * alone > 0, np.sign(both) * np.minimum(np.abs(both), np.abs(alone)), 0)


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in the order of keys, and the number of each key among them."""
    order = np.argsort(keys)
    new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(of, whole, strong) from the rows of chunks and their answers, sorted by chunk, part and bucket."""
    now, held = None, {}

    def measured() -> pa.RecordBatch:
        of, sizes, places = (_loosed(held[p][0], kind) for p, kind in ((_OF, np.int64), (_SIZES, np.int64), (_PLACES, np.int32)))
        known = _loosed_keys(held[_KNOWN][0])
        asked = _with_start(known)
        words, pairs = (np.concatenate([_loosed(raw, float).reshape(n, -1) for raw in held[p]], axis=1) for p, n in ((_WORD, 6), (_PAIR, 2)))
        at = places.astype(np.int64) + (len(asked) - len(known))
        before = _before(at, sizes)  # `_START` is the first of the asked words
        one, pair = _grouped(_pair_keys(asked[before], asked[at]))
        diff = _differences(before[one], at[one], words, pairs)[pair]
        text = np.repeat(np.arange(len(sizes)), sizes)
        whole = np.bincount(text, diff) / sizes
        excess = np.bincount(text, np.maximum(diff - _STRONG, 0))
        strong = np.log(excess / (sizes + 10) + 0.001)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (of, whole, strong)], names=["of", "whole", "strong"])

    for batch in batches:
        for chunk, part, raw, numbers in zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "keys", "numbers"))):
            if chunk != now and held:
                yield measured()
                held = {}
            now = chunk
            held.setdefault(part, []).append(raw if numbers is None else numbers)
    if held:
        yield measured()


@dataclass
class Tables:
    """Counts as tables: `pairs` (first, word, n0, n1), `firsts` (first, c0, c1, k0, k1: words and kinds of
    words after it), `words` (word, s0, s1: P of its class without a word before), and `unknown`, the
    same two of a word that is in no labelled text. Without rows of a class its model is uniform.
    `stored` has the first three as rows of buckets, of which there are 2**`bits`."""

    pairs: DataFrame
    firsts: DataFrame
    words: DataFrame
    unknown: tuple[float, float]
    stored: DataFrame
    bits: int

    def differences(self, asked: DataFrame) -> DataFrame:
        """`asked` (first, word) with `diff`: log P_toxic - log P_ordinary of the word after the first."""
        rows = asked.join(self.pairs, ["first", "word"], "left")
        rows = rows.join(self.firsts, "first", "left").join(self.words, "word", "left")
        logs, single = [], []
        for k in (0, 1):
            count, kinds = F.coalesce(f"c{k}", F.lit(0.0)), F.col(f"k{k}")
            alone = F.coalesce(f"s{k}", F.lit(self.unknown[k]))
            back = F.when(count > 0, F.least(F.lit(1.0), _DISCOUNT * kinds / count)).otherwise(1.0)
            own = F.greatest(F.coalesce(f"n{k}", F.lit(0)) - _DISCOUNT, F.lit(0.0))
            logs.append(F.log(F.when(count > 0, own / count).otherwise(0.0) + back * alone))
            single.append(F.log(alone))
        both, alone = logs[1] - logs[0], single[1] - single[0]
        bounded = F.signum(both) * F.least(F.abs(both), F.abs(alone))
        return rows.select("first", "word", F.when(both * alone > 0, bounded).otherwise(0.0).alias("diff"))

    def difference(self, words: np.ndarray, before: np.ndarray) -> np.ndarray:
        """`differences` of a few pairs."""
        asked = [(int(b), int(w)) for b, w in zip(before, words)]
        found = self.differences(self.pairs.sparkSession.createDataFrame(asked, "first long, word long").distinct())
        diff = {(r.first, r.word): r.diff for r in found.select("first", "word", "diff").collect()}
        return np.array([diff[a] for a in asked])

    # For looking at small tables only; scoring does not read these.
    @cached_property
    def _first(self) -> dict:
        return {r["first"]: r for r in self.firsts.collect()}

    @property
    def count(self) -> list[dict]:
        return [{w: r[f"c{k}"] for w, r in self._first.items()} for k in (0, 1)]

    @property
    def kinds(self) -> list[dict]:
        return [{w: r[f"k{k}"] for w, r in self._first.items()} for k in (0, 1)]

    @property
    def single(self) -> np.ndarray:
        rows = [(r.s0, r.s1) for r in self.words.collect()]
        return np.array([*rows, self.unknown]).T


def _dealt(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows dealt out by a key, in a fixed number of parts as few bytes mean much work, and sorted."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, key).sortWithinPartitions(key, *order)


def count_tables(labelled: DataFrame) -> Tables:
    """Tables from `labelled` (label 0/1, text): every pair and word of them, summed in Spark; the
    driver gets five totals."""
    found = _paired(labelled.select(F.col("label").cast("long"), "text"))
    n0, n1 = F.sum(F.when(F.col("of") == 0, F.col("n")).otherwise(0)), F.sum(F.when(F.col("of") == 1, F.col("n")).otherwise(0))
    pairs = pinned(found.groupBy("first", "word").agg(n0.alias("n0"), n1.alias("n1")), "zstd")
    sums = [F.sum(f"n{k}").cast("double").alias(f"c{k}") for k in (0, 1)]
    kinds = [F.sum((F.col(f"n{k}") > 0).cast("int")).cast("double").alias(f"k{k}") for k in (0, 1)]
    firsts = pinned(pairs.groupBy("first").agg(*sums, *kinds))
    after = pinned(pairs.groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("any"), *kinds))
    totals = after.agg(
        F.count(F.lit(1)), F.sum("any"), *[F.sum(f"k{k}") for k in (0, 1)],
        *[F.sum((F.col(f"k{k}") > 0).cast("int")) for k in (0, 1)],
    ).first()
    size, every, n, types = totals[0] + 1, totals[1] or 0.0, totals[2:4], totals[4:6]

    def alone(k: int, kinds: Column, shared: Column) -> Column:
        return (F.greatest(kinds - _DISCOUNT, F.lit(0.0)) + _DISCOUNT * types[k] * shared) / n[k] if n[k] else shared

    shared = (F.col("any") + 1) / (every + size)
    words = after.select("word", *[alone(k, F.col(f"k{k}"), shared).alias(f"s{k}") for k in (0, 1)])
    floor = 1 / (every + size)
    unknown = tuple(float(_DISCOUNT * types[k] * floor / n[k] if n[k] else floor) for k in (0, 1))
    words = pinned(words)
    removed(after.sparkSession, after)
    bits = max(_LEAST_BITS, int(np.ceil(np.log2(max(every, 1) / _BUCKET_ROWS))))
    both = firsts.withColumnRenamed("first", "word").join(words, "word", "full")
    blank = {f"{c}{k}": 0.0 for c in "ck" for k in (0, 1)} | {f"s{k}": unknown[k] for k in (0, 1)}
    both = both.select("word", *[F.coalesce(c, F.lit(x)).alias(c) for c, x in blank.items()])
    stored = [d.mapInArrow(tidied(partial(_stored, part=part, bits=bits)), _ROWS) for part, d in ((_WORD, both), (_PAIR, pairs))]
    stored = _dealt(stored[0].union(stored[1]), "bucket", "part").mapInArrow(tidied(partial(_merged, widths={_WORD: 6, _PAIR: 2})), _ROWS)
    return Tables(pairs, firsts, words, unknown, pinned(stored), bits)


def _slice_measures(texts: DataFrame, tables: Tables) -> DataFrame:
    spark = texts.sparkSession
    rows = pinned(texts.mapInArrow(tidied(partial(_asked, bits=tables.bits)), _ROWS))
    asks = tables.stored.union(rows.where(F.col("part") >= _WORD))
    missing = {_WORD: [0.0] * 4 + list(tables.unknown), _PAIR: [0.0, 0.0]}
    answers = _dealt(asks, "bucket", "part", "chunk").mapInArrow(tidied(partial(_answered, missing=missing)), _ROWS)
    both = answers.union(rows.where(F.col("part") < _WORD))
    out = pinned(_dealt(both, "chunk", "part", "bucket").mapInArrow(tidied(_summed), "of long, whole double, strong double"))
    removed(spark, rows)
    return out


def measures(texts: DataFrame, tables: Tables) -> DataFrame:
    """(of, text), `of` naming a text, to (of, whole, strong): mean difference per word, and the
    logarithm of the mean excess over `_STRONG`, smoothed by ten words without any. Texts without
    words have no row."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(_SLICES, 1 + size // _SLICE)
    part = F.pmod(F.col("of"), F.lit(n))
    found = reduce(DataFrame.union, [_slice_measures(texts.where(part == k), tables) for k in range(n)])
    return found.groupBy("of").agg(F.max("whole").alias("whole"), F.max("strong").alias("strong"))


def _measured(docs: DataFrame, tables: Tables, text: str, names: list[str]) -> DataFrame:
    (of,) = fresh(docs, "of__")
    keyed = docs.withColumn(of, F.xxhash64(text))  # a score depends on the text alone: copies are measured once
    found = measures(keyed.select(F.col(of).alias("of"), F.col(text).alias("text")), tables)
    found = found.select(F.col("of").alias(of), *[F.col(c).alias(n) for c, n in zip(("whole", "strong"), names)])
    rows = keyed.join(found, of, "left").drop(of)
    return rows.withColumns({names[0]: F.coalesce(names[0], F.lit(0.0)), names[1]: F.coalesce(names[1], F.lit(float(np.log(0.001))))})


@dataclass
class Model:
    tables: Tables
    weights: list[float]
    intercept: float


def fit(labelled: DataFrame, calibration: DataFrame) -> Model:
    """Counts from `labelled`, the curve from `calibration` (both label 0/1, text; all rows). If a
    class is missing in the calibration rows the score is the smoothed share of label 1."""
    tables = count_tables(labelled)
    rows = pinned(_measured(calibration.select("label", "text"), tables, "text", ["whole", "strong"]).drop("text"))
    counts = dict(rows.groupBy("label").count().collect())
    if len(counts) < 2:
        share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        return Model(tables, [0.0, 0.0], float(np.log(share / (1 - share))))
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    features = VectorAssembler(inputCols=["whole", "strong"], outputCol="features").transform(rows)
    curve = LogisticRegression(regParam=1e-4, maxIter=50).fit(features.select("features", F.col("label").cast("double")))
    return Model(tables, [float(w) for w in curve.coefficients], float(curve.intercept))


def scored(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """`docs` with `name` (0 to 1; replaced if there). NULL and empty texts score as texts without
    any evidence; every row gets a score from its whole text alone."""
    docs = docs.select(*[c for c in docs.columns if c != name])
    whole, strong = fresh(docs, "whole__", "strong__")
    rows = _measured(docs, model.tables, text, [whole, strong])
    odds = F.lit(model.intercept) + model.weights[0] * F.col(whole) + model.weights[1] * F.col(strong)
    return rows.withColumn(name, 1 / (1 + F.exp(-odds))).drop(whole, strong)


def trained(spark, sf_dir: str) -> Model:
    """Counts from seven in eight of the labelled documents that are not held out, the curve from
    the eighth."""
    labels = table(spark, sf_dir, "labels").where("toxic in (0, 1)")
    labels = labels.where(remainder(F.col("doc_id"), 3) != 1).select("doc_id", F.col("toxic").alias("label"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")
    kept_back = F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string")) / 3), F.lit(8)) == 7
    rows = pinned(docs.select("label", "text", kept_back.alias("kept_back")), "zstd")
    model = fit(rows.where(~F.col("kept_back")).drop("kept_back"), rows.where("kept_back").drop("kept_back"))
    removed(spark, rows)
    return model


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, trained(spark, sf_dir)).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
