"""Line deduplication by an exact set-similarity join.

A line is the set of its words. Its words are put in one global order, rare ones first; lines of
Jaccard similarity t share a word among the first n - ceil(t n) + 1 of each (prefix filter). Rows
of a word are met in the order of their length, and dropped by length, by position in the prefix
and by the parity bits of their words (which differ in at most as many bits as the sets differ in
words). What is left is verified on whole word sets. A line goes if an earlier line, by document
and then position, is as similar as `threshold`; repeats of a line are settled by its set alone.

A first pass asks for the nearest partner of each line per word, and where parity leaves doubt for
the next few as well; only lines that it leaves open, though a word offered more partners, ask for
all of them. So the pairs of a large group of copies are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, fresh, pinned, table, tidied, whole_runs

#: Word counts are kept in 2**_BITS buckets: a bounded table, used for the order only.
_BITS = 18
#: Rows in which a task gives its counts.
_CUTS = 256
#: About so many rows of a word meet in a task; words above are cut into parts that meet pairwise.
_ROWS_OF_WORD = 20_000
_LAST = (1 << 63) - 1
#: Partners that a line in doubt asks for at first, and the spare parity bits that leave no doubt.
_FEW = 4
_SPARE = 2
_MOST = 1 << 20
#: Lines of a text whose words are written together.
_SLICE = 4096
#: What names a line: its document's id and, where ids don't tell documents apart, a hash of its text.
_LINE = ["id", "digest", "line"]
_OTHER = ["other_id", "other_digest", "other_line"]


#: Bytes hashed together.
_PIECE = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACE.encode())] = True
_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's odd step and of its inverse, modulo 2**64."""
    back = pow(_STEP, -1, 1 << 64)
    out = []
    for base in (_STEP, back):
        low = np.cumprod(np.full(1 << 11, base, np.uint64))
        high = np.cumprod(np.full((_PIECE >> 11) + 1, low[-1], np.uint64))
        out.append(np.concatenate([low, (high[:, None] * low[None, :]).ravel()]))
    return out[0], out[1]


def _hashed(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of all words of `raw`: differences of running sums of
    value * step**place, moved to a common place, then mixed."""
    data = np.frombuffer(raw, np.uint8)
    space = np.r_[True, _SPACE[data], True]
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, stop = edges[::2], edges[1::2]
    if len(data) > _PIECE:  # a very long text has powers of its own
        power, back = (np.cumprod(np.full(len(data), b, np.uint64)) for b in (_STEP, pow(_STEP, -1, 1 << 64)))
    else:
        power, back = _powers()
    run = np.r_[np.uint64(0), np.cumsum(_VALUES[data] * power[: len(data)])]
    h = (run[stop] - run[start]) * back[start]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return start, h ^ (h >> np.uint64(32))


def _bytes(text: pa.StringScalar) -> bytes:
    """The UTF-8 of a text, NULL as empty."""
    return b"" if (held := text.as_buffer()) is None else held.to_pybytes()


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about `_PIECE` bytes, with the number of texts before them."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = _bytes(text)
        if held and size + len(raw) >= _PIECE:
            yield first, held
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield first, held


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts, cut into a few hundred rows."""
    total = np.zeros(1 << _BITS, np.int64)
    for batch in batches:
        for _, raws in _pieces(batch.column(0)):
            _, hashes = _hashed(b"\n".join(raws))
            total += np.bincount((hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64), minlength=1 << _BITS)
    yield from _cut_rows(dict(enumerate(total.reshape(_CUTS, -1))))


def _cut_rows(cuts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for cut, n in cuts.items():
        yield pa.RecordBatch.from_arrays([pa.array([cut], pa.int32()), pa.array([n])], names=["cut", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the rows of each cut."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for cut, n in zip(batch.column(0).to_pylist(), batch.column(1)):
            held[cut] = held.get(cut, 0) + n.values.to_numpy()
    yield from _cut_rows(held)


def word_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of words by hash bucket, over all documents; 2**18 numbers at most."""
    schema = "cut int, n array<long>"
    rows = docs.select(text).mapInArrow(tidied(_counts), schema).repartition("cut").mapInArrow(_added, schema).collect()
    out = np.zeros((_CUTS, (1 << _BITS) // _CUTS), np.int64)
    for cut, n in rows:
        out[cut] += np.array(n)
    return out.ravel()


def _ceiling(t: float, n: np.ndarray) -> np.ndarray:
    return np.ceil(t * n - 1e-9).astype(np.int64)


def _ordered(line: np.ndarray, place: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order by line, place of the word's bucket, hash. One packed key does for nearly all words."""
    if len(line) and line[-1] < 1 << 24:
        key = line.astype(np.uint64) << np.uint64(40) | place.astype(np.uint64) << np.uint64(40 - _BITS)
        key |= hashes >> np.uint64(64 - (40 - _BITS))
        order = np.argsort(key)
        key, named = key[order], hashes[order]
        if not ((key[1:] == key[:-1]) & (named[1:] != named[:-1])).any():  # repeats of a word may stand in any order
            return order
    return np.lexsort((hashes, place, line))


def _line_rows(batches: Iterator[pa.RecordBatch], counts: np.ndarray, t: float) -> Iterator[pa.RecordBatch]:
    place = np.empty(1 << _BITS, np.int64)
    place[np.argsort(counts, kind="stable")] = np.arange(1 << _BITS)
    for batch in batches:
        named, digest = batch.column(0).fill_null(_LAST).to_numpy(), batch.column(1).to_numpy()
        for before, raws in _pieces(batch.column(2)):
            of = slice(before, before + len(raws))
            yield _rows_of(named[of], digest[of], raws, counts, place, t)


def _rows_of(named: np.ndarray, digest: np.ndarray, raws: list[bytes], counts: np.ndarray, place: np.ndarray, t: float) -> pa.RecordBatch:
    raw = b"\n".join(raws)
    start, hashes = _hashed(raw)
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    line = np.searchsorted(breaks, start)  # counted over the joined texts
    bucket = (hashes & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    order = _ordered(line, place[bucket], hashes)
    line, hashes, bucket = line[order], hashes[order], bucket[order]
    new = np.r_[True, (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])][: len(line)]
    line, hashes, bucket = line[new], hashes[new], bucket[new]
    start = np.flatnonzero(np.r_[True, line[1:] != line[:-1]][: len(line)])
    size = np.diff(np.r_[start, len(line)])
    first = np.searchsorted(breaks, np.cumsum([0, *(len(r) + 1 for r in raws[:-1])]))  # each text's first line
    text = np.searchsorted(first, line[start], "right") - 1
    numbers = (line[start] - first[text]).astype(np.int32)
    with np.errstate(over="ignore"):
        mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key = _by_line(np.add, mixed ^ (mixed >> np.uint64(32)), start)
    bit, half = np.uint64(1) << (hashes >> np.uint64(58)), (hashes >> np.uint64(57)) & np.uint64(1)
    parity = [_by_line(np.bitwise_xor, np.where(half == k, bit, np.uint64(0)), start) for k in (0, 1)]
    prefix = size - _ceiling(t, size) + 1
    chosen = np.arange(len(hashes)) - np.repeat(start, size) < np.repeat(prefix, size)
    short = (hashes[chosen] >> np.uint64(16)).astype(np.uint32).view(np.int32)
    parts = np.maximum(1, -(-counts[bucket[chosen]] // _ROWS_OF_WORD)).astype(np.int32)
    ends = np.r_[0, np.cumsum(prefix)].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(named[text]), pa.array(digest[text]), pa.array(numbers), pa.array(key.view(np.int64)),
         *(pa.array(p.view(np.int64)) for p in parity), pa.array(size.astype(np.int32)),
         pa.ListArray.from_arrays(ends, short), pa.ListArray.from_arrays(ends, parts)],
        names=["id", "digest", "line", "key", "parity", "parity2", "n", "prefix", "parts"],
    )


def _by_line(add: np.ufunc, values: np.ndarray, start: np.ndarray) -> np.ndarray:
    return add.reduceat(values, start) if len(start) else values[:0]


def _partners(batches: Iterator[pa.RecordBatch], t: float) -> Iterator[pa.RecordBatch]:
    """Possible partners of lines that share a word: columns of the later line, then the earlier
    one. The nearest by parity is given and, if that one could still fail, a few others; `more`
    says that there are partners besides those given."""
    for rows in whole_runs(batches, "cell"):
        cell, size = rows.column("cell").to_numpy(), rows.column("size").to_numpy()
        order = np.lexsort((size, cell))
        cell, n, pos = cell[order], size[order] >> 32, size[order] & 0xFFFFFFFF
        id, digest, line, side = (rows.column(c).to_numpy()[order] for c in ("id", "digest", "line", "side"))
        parity, parity2 = (rows.column(c).to_numpy()[order].view(np.uint64) for c in ("parity", "parity2"))
        stop = np.r_[np.flatnonzero(cell[1:] != cell[:-1]) + 1, len(cell)]
        stop = stop[np.searchsorted(stop, np.arange(len(cell)), "right")]
        best = np.full(len(cell), 1 << 60, np.int64)  # lack of spare bits and index of the partner
        seen = np.zeros(len(cell), np.int32)
        pairs = [(np.zeros(0, np.int64),) * 2]
        # the shorter of two lines has a common word among its first n - ceil(2 t n / (1 + t)) + 1
        alive, step = np.flatnonzero(pos <= n - _ceiling(2 * t / (1 + t), n)), 0
        while len(alive):
            step += 1
            alive = alive[alive + step < stop[alive]]
            alive = alive[_ceiling(t, n[alive + step]) <= n[alive]]
            i, j = alive, alive + step
            need = _ceiling(t / (1 + t), n[i] + n[j])
            most = np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j])
            bits = np.bitwise_count(parity[i] ^ parity[j]).astype(np.int64) + np.bitwise_count(parity2[i] ^ parity2[j])
            spare = n[i] + n[j] - 2 * need - bits
            ok = (most >= need) & (spare >= 0) & ((side[i] & 1 == 1) | (side[i] != side[j]))
            ok &= (id[i] != id[j]) | (line[i] != line[j]) | (digest[i] != digest[j])
            i, j, spare = i[ok], j[ok], spare[ok]
            first = (digest[i] < digest[j]) | ((digest[i] == digest[j]) & (line[i] < line[j]))
            first = (id[i] < id[j]) | ((id[i] == id[j]) & first)
            later, earlier = np.where(first, j, i), np.where(first, i, j)
            np.minimum.at(best, later, np.maximum(_MOST - spare, 0) * len(cell) + earlier)
            np.add.at(seen, later, 1)
            few = (seen[later] <= _FEW) & (spare < _SPARE)
            pairs.append((later[few], earlier[few]))
        sure = best < (_MOST - _SPARE + 1) * len(cell)
        later, earlier = (np.concatenate(x) for x in zip(*pairs))
        doubt = ~sure[later]
        nearest = np.flatnonzero((seen > _FEW) | (sure & (seen > 0)))
        later, earlier = np.r_[later[doubt], nearest], np.r_[earlier[doubt], best[nearest] % len(cell)]
        more = seen[later] > np.where(sure[later], 1, _FEW)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (id[later], digest[later], line[later], id[earlier], digest[earlier], line[earlier], cell[later], more)],
            names=[*_LINE, *_OTHER, "cell", "more"],
        )


def _cells(sets: DataFrame) -> DataFrame:
    """A row for each line, word of its prefix, and cell of that word. `size`: words of the line,
    and place of this one in the low half; `side`: twice the part, odd where a part meets itself."""
    rows = sets.select(*_LINE, "parity", "parity2", "n", F.posexplode(F.arrays_zip("prefix", "parts")).alias("pos", "word"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*_LINE), F.col("word.parts")).cast("int"))
    rows = rows.withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("word.parts") - 1)))
    return rows.select(
        F.xxhash64("word.prefix", F.least("part", "meets"), F.greatest("part", "meets")).alias("cell"),
        *_LINE, "parity", "parity2",
        F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("pos").cast("long")).alias("size"),
        (2 * F.col("part") + (F.col("part") == F.col("meets")).cast("int")).alias("side"),
    )


def _met(cells: DataFrame, t: float) -> DataFrame:
    sorted_cells = cells.repartition("cell").sortWithinPartitions("cell")
    return sorted_cells.mapInArrow(
        tidied(partial(_partners, t=t)),
        "id long, digest long, line int, other_id long, other_digest long, other_line int, cell long, more boolean",
    )


def _all_partners(cells: DataFrame, asking: DataFrame, t: float) -> DataFrame:
    """Every possible partner of the `asking` rows of `cells`: the filters of `_partners` as the
    condition of a join, so that only what passes them becomes a row."""
    theirs = cells.select("cell", *[F.col(c).alias(f"other_{c}") for c in cells.columns if c != "cell"])
    mine, their = F.struct(*_LINE), F.struct(*_OTHER)
    n, m = (F.shiftright(c, 32) for c in ("size", "other_size"))
    pos, at = (F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in ("size", "other_size"))
    need = F.ceil(t / (1 + t) * (n + m) - 1e-9)
    bits = F.bit_count(F.col("parity").bitwiseXOR(F.col("other_parity"))) + F.bit_count(F.col("parity2").bitwiseXOR(F.col("other_parity2")))
    near = (
        (their < mine)
        & (F.ceil(t * F.greatest(n, m) - 1e-9) <= F.least(n, m))
        & ((F.col("side") % 2 == 1) | (F.col("side") != F.col("other_side")))
        & (F.least(pos, at) + F.least(n - pos, m - at) >= need)
        & (bits <= n + m - 2 * need)
    )
    joined = theirs.join(asking, (theirs["cell"] == asking["cell"]) & near)
    return joined.select(*_LINE, *_OTHER)


def _asked_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word sets of the asked lines of documents: every text is split once, one at a time."""
    for batch in batches:
        ids, digests = batch.column(0), batch.column(1)
        for i in range(batch.num_rows):
            asked = batch.column(2)[i].as_py()
            split = _bytes(batch.column(3)[i]).split(b"\n")
            for at in range(0, len(asked), _SLICE):
                some = [line for line in asked[at : at + _SLICE] if line < len(split)]
                words = [list(dict.fromkeys(split[line].split())) for line in some]
                ends = np.r_[0, np.cumsum([len(w) for w in words])]
                flat = pa.array([w for each in words for w in each], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i].as_py()] * len(some), pa.int64()), pa.array([digests[i].as_py()] * len(some), pa.int64()),
                     pa.array(some, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)],
                    names=[*_LINE, "words"],
                )


def _verified(pairs: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """Lines of which a pair reaches the threshold on the word sets themselves. `docs`: id, digest, text;
    rows alike in id and digest are one document."""
    pairs = pinned(pairs.select(*_LINE, *_OTHER).distinct())
    asked = pairs.select(*_LINE).union(pairs.select(*_OTHER)).distinct()
    asked = pinned(asked.groupBy("id", "digest").agg(F.collect_list("line").alias("lines")))  # a document's own lines
    rows = docs.join(asked.hint("shuffle_hash"), ["id", "digest"])  # one kind of join at every size
    words = pinned(rows.select("id", "digest", "lines", "text").mapInArrow(
        tidied(_asked_words), "id long, digest long, line int, words array<string>"))
    other = words.select(*[F.col(c).alias(o) for c, o in zip(_LINE, _OTHER)], F.col("words").alias("theirs"))
    both = pairs.join(words, _LINE).join(other, _OTHER)
    common = F.size(F.array_intersect("words", "theirs"))
    union = F.size("words") + F.size("theirs") - common
    return both.where(common >= t * union - 1e-9).select(*_LINE).distinct()


def _named(docs: DataFrame, id: str, text: str) -> tuple[Column, Column]:
    """What names a document: its id (NULL as the largest bigint), and a digest of the text if any id
    is NULL or shared, else 0."""
    unique = docs.groupBy(id).count().where(F.col(id).isNull() | (F.col("count") > 1)).isEmpty()
    digest = F.lit(0).cast("long") if unique else F.xxhash64(text)
    return F.coalesce(F.col(id), F.lit(_LAST)), digest


def _repeated(docs: DataFrame, threshold: float) -> DataFrame:
    """(id, digest, lines) of `docs` (id, digest, text)."""
    counts = word_counts(docs, "text")
    lines = pinned(
        docs.mapInArrow(
            tidied(partial(_line_rows, counts=counts, t=threshold)),
            "id long, digest long, line int, key long, parity long, parity2 long, n int, prefix array<int>, parts array<int>",
        )
    )
    place = F.struct(*_LINE)
    sets = pinned(
        lines.groupBy("key", "parity", "parity2", "n")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min_by("prefix", place).alias("prefix"), F.min_by("parts", place).alias("parts"))
        .select("key", "parity", "parity2", "n", "first.*", (F.col("first") != F.col("last")).alias("again"), "prefix", "parts")
    )
    cells = _cells(sets)
    met = pinned(_met(cells, threshold))
    found = pinned(_verified(met, docs, threshold))
    left = pinned(met.where("more").join(found, _LINE, "left_anti").select(*_LINE, "cell").distinct())
    open_sets = sets.join(left.select(*_LINE).distinct(), _LINE, "left_semi")
    asking = pinned(_cells(open_sets).join(left, [*_LINE, "cell"], "left_semi"))
    also = _verified(pinned(_all_partners(cells, asking, threshold)), docs, threshold)
    identity = ["key", "parity", "parity2", "n"]
    again = lines.join(sets.where("again").select(*identity, F.struct(*_LINE).alias("first")), identity)
    copies = again.where(F.struct(*_LINE) > F.col("first")).select(*_LINE)
    gone = found.union(also).union(copies)
    return gone.groupBy("id", "digest").agg(F.collect_set("line").alias("lines"))


def repeated_lines(docs: DataFrame, threshold: float = 0.8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lines): per document the numbers (from 0) of the lines that an earlier line makes
    redundant. NULL ids come after all others (as the largest bigint). A document is an id with a text: rows of one id (or
    none) with different texts are different documents, in the order of a hash of their texts, and
    have a row each; rows alike in both are one, whose lines don't make each other redundant. Lines
    without words never go."""
    name, digest = _named(docs, id, text)
    rows = docs.select(name.alias("id"), digest.alias("digest"), F.col(text).alias("text"))
    return _repeated(rows, threshold).select("id", "lines")


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of line numbers as masks, up to the last of them."""
    for batch in batches:
        masks = []
        for lines in batch.column("lines"):
            numbers = lines.values.to_numpy()
            masks.append(np.zeros(numbers.max(initial=-1) + 1, bool))
            masks[-1][numbers] = True
        ends = pa.array(np.r_[0, np.cumsum([len(m) for m in masks])], pa.int32())
        column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, bool), *masks])))
        yield batch.set_column(batch.schema.get_field_index("lines"), "lines", column)


def deduplicated(docs: DataFrame, threshold: float = 0.8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the redundant lines (`repeated_lines`) taken out of `text`; all rows and columns stay. A
    text of which every line goes becomes empty; NULL stays NULL. A column n_chars follows the new text."""
    key, of, lines = fresh(docs, "line_id__", "line_digest__", "gone__")
    name, digest = _named(docs, id, text)
    rows = docs.select(name.alias("id"), digest.alias("digest"), F.col(text).alias("text"))
    gone = pinned(_repeated(rows, threshold).mapInArrow(_masks, "id long, digest long, lines array<boolean>"))
    gone = gone.select(F.col("id").alias(key), F.col("digest").alias(of), F.col("lines").alias(lines))
    joined = docs.withColumns({key: name, of: digest}).join(gone.hint("shuffle_hash"), [key, of], "left").drop(key, of)
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.coalesce(F.get(lines, i), F.lit(False))), "\n")
    out = joined.withColumn(text, F.when(F.col(lines).isNull(), F.col(text)).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(lines).isNull(), F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """Per document: its text without the lines that an earlier line makes redundant."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs)
