"""Byte-level BPE: encoding and decoding with given ranks.

Pre-tokens are found without regular expressions. Every code point gets a class; with one
look-ahead the classes become symbols of a small automaton, whose transition functions are
composed block by block (composition is associative), so that all block starts are known before
the blocks are run side by side in numpy. The slices are merged by rank, once per distinct
slice: results are cached.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, tidied

# White space of the pattern, and the endings that an apostrophe may take.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ENDINGS_ONE = "stmd"
ENDINGS_TWO = ("re", "ve", "ll")

LETTER, NUMBER, OTHER, SPACE, BREAK = range(5)
#: Symbols: the classes (SPACE: more white space or the end follows), then with look-ahead.
LAST_SPACE, BLANK, SHORT, LONG = 5, 6, 7, 8
#: States: a token of the class is open, a blank waits for its run, n letters of an ending are due.
START, IN_LETTER, IN_NUMBER, IN_OTHER, IN_SPACE, WAITING, DUE_ONE, DUE_TWO = range(8)
_CACHED = 240_000
_NONE = 1 << 40
_BLOCK = 256


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """next[state, symbol] and boundary[state, symbol] (a token starts at this code point)."""
    nxt, cut = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    nxt[:, LETTER], nxt[:, NUMBER], nxt[:, OTHER], nxt[:, SPACE] = IN_LETTER, IN_NUMBER, IN_OTHER, IN_SPACE
    nxt[:, BREAK], nxt[:, LAST_SPACE], nxt[:, BLANK] = START, IN_SPACE, WAITING
    nxt[:, SHORT], nxt[:, LONG] = DUE_ONE, DUE_TWO
    for state, symbol in ((IN_LETTER, LETTER), (IN_NUMBER, NUMBER), (IN_OTHER, OTHER), (IN_SPACE, SPACE),
                          (WAITING, LETTER), (WAITING, NUMBER), (WAITING, OTHER)):
        cut[state, symbol] = False
    for state in (IN_OTHER, WAITING):  # an apostrophe inside a run, or after its blank, starts no ending
        for symbol in (SHORT, LONG):
            nxt[state, symbol], cut[state, symbol] = IN_OTHER, False
    nxt[DUE_TWO, LETTER], cut[DUE_TWO, LETTER] = DUE_ONE, False
    nxt[DUE_ONE, LETTER], cut[DUE_ONE, LETTER] = START, False
    return nxt, cut


def _monoid(nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All transition functions that compositions of symbols reach, and compose[f, g] (first f)."""
    found = [tuple(nxt[:, s]) for s in range(nxt.shape[1])]
    found = list(dict.fromkeys([*found, tuple(range(8))]))
    index = {f: i for i, f in enumerate(found)}
    for f in found:  # grows while it runs
        for g in list(found):
            for h in (tuple(g[x] for x in f), tuple(f[x] for x in g)):
                if h not in index:
                    index[h] = len(found)
                    found.append(h)
    compose = np.array([[index[tuple(g[x] for x in f)] for g in found] for f in found], np.uint8)
    return np.array(found, np.uint8), compose


NEXT, CUT = _transitions()
FUNCTIONS, COMPOSE = _monoid(NEXT)
_OF_SYMBOL = np.array([next(i for i, f in enumerate(FUNCTIONS) if tuple(f) == tuple(NEXT[:, s])) for s in range(9)], np.uint8)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point; one more entry is the break between texts."""
    out = np.full(0x110001, OTHER, np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    for code in range(0x110000):
        out[code] = kind.get(category(chr(code))[0], OTHER)
    out[WHITE_SPACE] = SPACE
    out[0x110000] = BREAK
    return out


def _symbols(codes: np.ndarray) -> np.ndarray:
    kind = classes()[codes]
    following = np.r_[kind[1:], np.uint8(BREAK)]
    symbol = kind.copy()
    last = (kind == SPACE) & (following != SPACE) & (following != BREAK)
    symbol[last] = np.where(codes[last] == 32, BLANK, LAST_SPACE)
    at = np.flatnonzero(codes == 39)
    one, two = codes[np.minimum(at + 1, len(codes) - 1)], codes[np.minimum(at + 2, len(codes) - 1)]
    symbol[at[np.isin(one, [ord(c) for c in ENDINGS_ONE])]] = SHORT
    for a, b in ENDINGS_TWO:
        symbol[at[(one == ord(a)) & (two == ord(b))]] = LONG
    return symbol


def _starting_states(functions: np.ndarray) -> np.ndarray:
    """State before each function of a sequence that begins in START, by a blocked scan."""
    n = len(functions)
    if n <= _BLOCK:
        out, state = np.zeros(n, np.uint8), START
        for i, f in enumerate(functions):
            out[i], state = state, FUNCTIONS[f, state]
        return out
    rows = -(-n // _BLOCK)
    padded = np.full(rows * _BLOCK, _IDENTITY, np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    total = columns[0]
    for column in columns[1:]:
        total = COMPOSE[total, column]
    state = _starting_states(total)
    out = np.empty((_BLOCK, rows), np.uint8)
    for i, column in enumerate(columns):
        out[i] = state
        state = FUNCTIONS[column, state]
    return out.T.reshape(-1)[:n]


_IDENTITY = next(i for i, f in enumerate(FUNCTIONS) if tuple(f) == tuple(range(8)))


def boundaries(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The joined text, the starts of all pre-tokens in it, and each text's first start index.

    Texts are joined with a lone code point of the class BREAK; its own "token" is left out."""
    joined = "\0".join(texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    codes[ends] = 0x110000
    symbol = _symbols(codes)
    states = _starting_states(_OF_SYMBOL[symbol])
    starts = np.flatnonzero(CUT[states, symbol])
    return joined, starts, np.searchsorted(starts, np.r_[0, ends[:-1] + 1])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merger(dict):
    """Cache from pre-token to its ids, bounded: a full generation becomes the old one, from which
    used entries move up again. `learn` merges all pre-tokens that are new, side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.old, self.limit = ranks, {}, _CACHED
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = {}
        for whole, rank in ranks.items():
            for cut in range(1, len(whole)):
                if (a := ranks.get(whole[:cut])) is not None and (b := ranks.get(whole[cut:])) is not None:
                    pairs[a << 32 | b] = rank
        self.slots = 1 << max(4, (4 * len(pairs)).bit_length())
        self.keys, self.made = np.full(self.slots, -1, np.int64), np.full(self.slots, _NONE, np.int64)
        key, made = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self._slot(key)
        while len(key):  # of pairs that want a free slot one gets it, the others go on
            free = self.keys[at] < 0
            self.keys[at[free]], self.made[at[free]] = key[free], made[free]
            lost = self.keys[at] != key
            key, made, at = key[lost], made[lost], (at[lost] + 1) % self.slots
        self.made[self.keys < 0] = _NONE

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % self.slots

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens make, or a number above all ranks."""
        key = a << 32 | b
        at = self._slot(key)
        out = np.full(len(key), _NONE, np.int64)
        left = np.arange(len(key))
        while len(left):
            found = self.keys[at]
            hit = found == key[left]
            out[left[hit]] = self.made[at[hit]]
            on = ~hit & (found >= 0)
            left, at = left[on], (at[on] + 1) % self.slots
        return out

    def __missing__(self, text: str) -> tuple[int, ...]:
        self.learn([text])
        return self.pop(text) if len(text) > 64 else self[text]

    def learn(self, texts: list[str]) -> None:
        """Adds the ids of `texts`, which are not in the cache."""
        if len(self) + len(texts) > self.limit:
            self.old = dict(self)
            self.clear()
        short: list[str] = []
        raws: list[bytes] = []
        for text in texts:
            ids = self.old.get(text)
            if ids is None:
                raw = text.encode("utf-8", "surrogatepass")
                if raw in self.ranks:
                    ids = (self.ranks[raw],)
                elif len(raw) > 256:
                    ids = self._merged_long(raw)
                else:
                    short.append(text)
                    raws.append(raw)
                    continue
            self[text] = ids
        for text, ids in zip(short, self._merged(raws)):
            self[text] = ids

    def _merged(self, raws: list[bytes]) -> list[tuple[int, ...]]:
        """In each round every piece merges its first pair of least rank; pieces without one are done."""
        out: list = [None] * len(raws)
        size = np.array([len(r) for r in raws], np.int64)
        token = self.bytes[np.frombuffer(b"".join(raws), np.uint8)]
        piece = np.repeat(np.arange(len(raws)), size)
        rank = np.full(len(token), _NONE, np.int64)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.joined(token[inner], token[inner + 1])
        while len(token):
            start = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            length = np.diff(np.r_[start, len(piece)])
            least = np.minimum.reduceat(rank, start)
            done = least == _NONE
            if done.any():
                flat = token[np.repeat(done, length)].tolist()
                at = 0
                for p, n in zip(piece[start[done]].tolist(), length[done].tolist()):
                    out[p] = tuple(flat[at : at + n])
                    at += n
                stay = np.repeat(~done, length)
                token, piece, rank = token[stay], piece[stay], rank[stay]
                least, length = least[~done], length[~done]
                if not len(token):
                    break
            best = np.flatnonzero(rank == np.repeat(least, length))
            best = best[np.r_[True, piece[best[1:]] != piece[best[:-1]]]]
            token[best] = rank[best]
            stay = np.ones(len(token), bool)
            stay[best + 1] = False
            token, piece, rank = token[stay], piece[stay], rank[stay]
            best -= np.arange(len(best))  # one place fewer for each merge before
            for i in (best, best[best > 0] - 1):
                inside = i + 1 < len(token)
                rank[i[~inside]] = _NONE
                i = i[inside]
                pair = piece[i] == piece[i + 1]
                rank[i[~pair]] = _NONE
                i = i[pair]
                rank[i] = self.joined(token[i], token[i + 1])
        return out

    def _merged_long(self, raw: bytes) -> tuple[int, ...]:
        """The same with a heap and linked parts, so that very long runs stay near-linear."""
        get, n = self.ranks.get, len(raw)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(raw[k : end[after[k]]])) is not None:
                    heapq.heappush(heap, (r, k, end[after[k]]))
        return tuple(get(raw[i : end[i]]) for i in range(n) if alive[i])


@lru_cache(4)
def _merger(path: str) -> Merger:
    return Merger(load_ranks(path))


def encode_texts(texts: list[str], merger: Merger) -> Iterator[list[int]]:
    """Ids of each text."""
    joined, starts, first = boundaries(texts)
    edges = starts.tolist()
    edges.append(len(joined))
    slices = list(map(joined.__getitem__, map(slice, edges, edges[1:])))
    merger.learn([s for s in set(slices) if s not in merger])
    parts = list(map(merger.__getitem__, slices))
    first = [*first.tolist(), len(starts)]
    for a, b in zip(first, first[1:]):  # the last part of a text is the break
        yield list(chain.from_iterable(parts[a : b - 1]))


def _groups(texts: list[str], limit: int = 1 << 19) -> Iterator[list[str]]:
    """Consecutive texts of about `limit` code points together; a longer text alone."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def encode(docs: DataFrame, path: str, text: str = "text", cached: int = _CACHED) -> DataFrame:
    """`docs` with `ids` (array<int>) and `offsets` (array<int>: first byte of each token).

    `cached`: pre-tokens that a worker remembers at a time; it changes memory and time, never ids.

    `path`: a rank file in tiktoken's format, present on every worker. A NULL text counts as
    empty; empty texts have no ids. Columns named ids or offsets are replaced. Rows are kept
    as they are, repeated ones too. Special tokens are ordinary text."""
    rest = [c for c in docs.columns if c not in ("ids", "offsets")]
    docs = docs.select(*rest)
    at = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(path)
        merger.limit = cached
        width = np.zeros(max(merger.ranks.values(), default=0) + 1, np.int32)
        for raw, i in merger.ranks.items():
            width[i] = len(raw)
        for batch in batches:
            done = 0
            for group in _groups([t or "" for t in batch.column(at).to_pylist()]):
                flat, sizes = array("i"), []
                for ids in encode_texts(group, merger):
                    flat.extend(ids)
                    sizes.append(len(ids))
                values = np.frombuffer(flat, np.int32) if flat else np.zeros(0, np.int32)
                ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                bytes_before = np.cumsum(np.r_[0, width[values]])
                offsets = bytes_before[:-1] - np.repeat(bytes_before[ends[:-1]], sizes)
                lists = [pa.ListArray.from_arrays(ends, x.astype(np.int32)) for x in (values, offsets)]
                part = batch.slice(done, len(group))
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=[*rest, "ids", "offsets"])
                done += len(group)
        merger.old = {}  # between its tasks a worker keeps one generation

    ints = T.ArrayType(T.IntegerType())
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField("ids", ints), T.StructField("offsets", ints)]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` with `decoded` (binary): the bytes of the ids, joined. NULL ids give NULL; an
    id without a rank raises. A column named decoded is replaced."""
    rest = [c for c in encoded.columns if c != "decoded"]
    encoded = encoded.select(*rest)
    at = rest.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = {i: b for b, i in _merger(path).ranks.items()}
        for batch in batches:
            lists = batch.column(at)
            values, ends = lists.values.to_numpy(), lists.offsets.to_pylist()  # ids of a text at a time become objects
            data = [None if not ok else b"".join(map(raw.__getitem__, values[a:b].tolist()))
                    for ok, a, b in zip(lists.is_valid().to_pylist(), ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*rest, "decoded"])

    return encoded.mapInArrow(tidied(run), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def packed_digest(encoded: DataFrame, name: str) -> DataFrame:
    """`encoded` with `name`: SHA-256 of the ids as little-endian unsigned 32-bit integers."""
    rest = [c for c in encoded.columns if c != name]
    encoded = encoded.select(*rest)
    at = rest.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            values, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_pylist()
            data = [hashlib.sha256(values[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.string())], names=[*rest, name])

    return encoded.mapInArrow(tidied(run), T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())]))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: n_tokens, ids_sha256, decoded_sha256, all from the real ids and bytes."""
    encoded = encode(docs.select("doc_id", "text"), path).drop("text", "offsets")
    both = decode(packed_digest(encoded, "ids_sha256"), path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), rank_file())
