"""Chat formatting: conversations as one token sequence with a loss mask.

A conversation is rendered whole, encoded once with byte offsets, and the sorted spans of its
assistant turns are laid over the sorted token offsets by binary search. Control strings mark the
turns; each is one special token, which no neighbouring text can merge with, so no token lies across
the edge of a span. Control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import byte_bpe
from .common import table

# The control strings, and how a turn of each role opens and closes.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[NONE]"]
OPENING = {"assistant": "<s>", "user": "<s>[INST]", "system": "<s>[SYS]", None: "<s>[NONE]"}
CLOSING = {"assistant": "</s>", "user": "[/INST]</s>", "system": "[/SYS]</s>", None: "</s>"}
OTHER_OPENING = "<s>[ROLE]{}[/ROLE]"
LEARNED = "assistant"

#: A control string with any number of escapes behind its first character. No control string holds
#: `<` or `[` past its first character, so occurrences never overlap, within a text or at its edges.
_MARK = re.compile(r"<\\*/?s>|\[\\*/?(?:INST|SYS|ROLE)\]|\[\\*NONE\]")
_SPLIT = re.compile("(" + "|".join(re.escape(c) for c in CONTROLS) + ")")
#: Turns of a block, by turn number; code points that a segment holds before it is closed.
_BLOCK_TURNS = 512
_SEGMENT = 1 << 20

SEGMENT_SCHEMA = (
    "conv_id bigint, block bigint, segment int, n_turns bigint, formatted string, "
    "ids array<int>, offsets array<int>, loss_mask array<boolean>"
)


def escape(text: str) -> str:
    """One more escape in every control string, escaped or not, so that none is left bare."""
    return _MARK.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of `escape`."""
    return _MARK.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(turns: list[tuple[str | None, str]]) -> tuple[str, np.ndarray]:
    """The formatted conversation, and the code-point span [start, end) of each assistant text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        known = role in OPENING
        opening = OPENING[role] if known else OTHER_OPENING.format(escape(role))
        body = escape(text)
        if role == LEARNED:
            spans.append((at + len(opening), at + len(opening) + len(body)))
        parts += [opening, body, CLOSING[role] if known else CLOSING[None]]
        at += sum(map(len, parts[-3:]))
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> Iterator[tuple[str | None, str]]:
    """The turns of a formatted conversation, read back from its control strings."""
    pieces = _SPLIT.split(formatted)  # text, control, text, control, ..., text
    role, at_role = LEARNED, False
    kept = ""
    for text, control in zip(pieces[::2], [*pieces[1::2], ""]):
        if at_role:
            role, at_role = unescape(text), False
        elif text:
            kept = text
        if control == "<s>":
            role, kept = LEARNED, ""
        elif control in ("[INST]", "[SYS]", "[NONE]"):
            role = {"[INST]": "user", "[SYS]": "system", "[NONE]": None}[control]
        elif control == "[ROLE]":
            at_role = True
        elif control == "</s>":
            yield role, unescape(kept)


@lru_cache(4)
def _vocabulary(path: str) -> tuple[dict[str, int], np.ndarray, list[bytes]]:
    """Ids of the control strings (after the ranks), and the bytes of every id."""
    ranks = byte_bpe._merger(path).ranks
    first = max(ranks.values(), default=-1) + 1
    special = {c: first + i for i, c in enumerate(CONTROLS)}
    raw = [b""] * first + [c.encode() for c in CONTROLS]
    for piece, i in ranks.items():
        raw[i] = piece
    return special, np.array([len(r) for r in raw], np.int64), raw


def encode_formatted(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each formatted text; a bare control string is its special token."""
    special, _, _ = _vocabulary(path)
    pieces = [_SPLIT.split(t) for t in texts]
    plain = byte_bpe.encode_texts([p for split in pieces for p in split[::2]], byte_bpe._merger(path))
    out = []
    for split in pieces:
        ids: list[int] = []
        for i, piece in enumerate(split):
            ids += [special[piece]] if i % 2 else next(plain)
        out.append(np.array(ids, np.int64))
    return out


def byte_spans(text: str, spans: np.ndarray) -> np.ndarray:
    """Code-point spans of `text` as spans of its UTF-8."""
    if text.isascii() or not len(spans):
        return spans
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
    return np.r_[0, np.cumsum(width)][spans]


def masked(offsets: np.ndarray, total: int, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span. `offsets`: first byte of each token, rising; `spans`: sorted and
    apart. Two binary searches a span find its first and last token."""
    mask = np.zeros(len(offsets), bool)
    ends = np.r_[offsets[1:], total] if len(offsets) else offsets
    first, last = np.searchsorted(offsets, spans[:, 0]), np.searchsorted(ends, spans[:, 1], "right")
    edge = np.zeros(len(offsets) + 1, np.int64)
    some = last > first
    np.add.at(edge, first[some], 1)
    np.add.at(edge, last[some], -1)
    mask[:] = np.cumsum(edge[:-1]) > 0
    return mask


def _encoded(held: list[tuple], path: str) -> pa.RecordBatch:
    """Segments (conv_id, block, segment, turns), rendered and encoded side by side."""
    drawn = [render(turns) for *_, turns in held]
    _, width, _ = _vocabulary(path)
    ids, offsets, masks = encode_formatted([text for text, _ in drawn], path), [], []
    for (text, spans), found in zip(drawn, ids):
        ends = np.cumsum(width[found])
        offsets.append(ends - width[found])
        masks.append(masked(offsets[-1], int(ends[-1]) if len(ends) else 0, byte_spans(text, spans)))
    edges = pa.array(np.r_[0, np.cumsum([len(i) for i in ids])], pa.int32())
    lists = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(x).astype(kind)))
             for x, kind in ((ids, np.int32), (offsets, np.int32), (masks, bool))]
    return pa.RecordBatch.from_arrays(
        [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
         pa.array([h[2] for h in held], pa.int32()), pa.array([len(h[3]) for h in held], pa.int64()),
         pa.array([text for text, _ in drawn]), *lists],
        names=["conv_id", "block", "segment", "n_turns", "formatted", "ids", "offsets", "loss_mask"],
    )


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of sorted batches, a slice of about a megabyte of them as objects at a time."""
    for batch in batches:
        step = max(1, int(batch.num_rows * (1 << 20) / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def formatted(conversations: DataFrame, path: str) -> DataFrame:
    """`conversations` (conv_id, turn, role, text) as segments: SEGMENT_SCHEMA, offsets in bytes of
    the segment's own UTF-8, the mask true on tokens of assistant texts.

    A conversation's turns are its rows by turn (NULL first), equal ones by role and text (NULL
    first); repeated rows are turns too. A NULL text is empty; a NULL role is a role. All rows with
    NULL conv_id are one conversation. Other columns play no part; an empty table gives no rows. `path`:
    a rank file in tiktoken's format, present on every worker. A conversation is one segment, but a very
    long one is cut between turns: by blocks of 512 turn numbers, which are dealt to
    tasks apart, and after about 2^20 code points. Since turns begin and end with special tokens, the
    segments' tokens in order of (block, segment) are those of the whole."""
    block = F.floor(F.col("turn") / _BLOCK_TURNS).cast("bigint")
    rows = conversations.select("conv_id", block.alias("block"), "turn", "role", "text")
    order = ["conv_id", "block", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for (conv, part), turns in groupby(_rows(batches, "conv_id", "block", "role", "text"), lambda r: r[:2]):
            held.append((conv, part, 0, []))
            long = 0
            for _, _, role, text in turns:
                text = text or ""
                if held[-1][3] and long + len(text) > _SEGMENT:
                    yield _encoded(held, path)
                    held, size, long = [(conv, part, held[-1][2] + 1, [])], 0, 0
                held[-1][3].append((role, text))
                long += len(text)
                size += len(text) + 32
            if size > _SEGMENT:
                yield _encoded(held, path)
                held, size = [], 0
        if held:
            yield _encoded(held, path)

    dealt = rows.repartition("conv_id", "block").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, SEGMENT_SCHEMA)


def read_back(segments: DataFrame, path: str) -> DataFrame:
    """Per segment of `formatted`: turns (binary: role, newline, text, newline of each turn, from the
    formatted text), loss (binary: the texts under the mask, from the ids), and the counts
    n_turns, loss_chars, formatted_chars."""
    schema = "conv_id bigint, block bigint, segment int, turns binary, loss binary, n_turns bigint, loss_chars bigint, formatted_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, raw = _vocabulary(path)
        for batch in batches:
            ids, masks = batch.column("ids"), batch.column("loss_mask")
            out = []
            for i in range(batch.num_rows):
                text = batch.column("formatted")[i].as_py()
                turns = list(parse(text))
                mask = np.asarray(masks[i].values, bool)
                found = ids[i].values.to_numpy()
                edge = np.flatnonzero(np.diff(np.r_[False, mask, False]))  # runs of masked tokens
                learned = [unescape(b"".join(map(raw.__getitem__, found[a:b].tolist())).decode("utf-8", "surrogatepass"))
                           for a, b in zip(edge[::2], edge[1::2])]
                out.append((
                    "".join(f"{role or ''}\n{t}\n" for role, t in turns).encode("utf-8", "surrogatepass"),
                    "".join(learned).encode("utf-8", "surrogatepass"), len(turns), sum(map(len, learned)), len(text),
                ))
            turns, loss, n, chars, whole = zip(*out) if out else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"), batch.column("segment"),
                 pa.array(turns, pa.binary()), pa.array(loss, pa.binary()),
                 *(pa.array(x, pa.int64()) for x in (n, chars, whole))],
                names=["conv_id", "block", "segment", "turns", "loss", "n_turns", "loss_chars", "formatted_chars"],
            )

    return segments.mapInArrow(run, schema)


def digests(segments: DataFrame, path: str) -> DataFrame:
    """Per conversation, read back from its segments: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. A digest is a chain over all turns, so each conversation streams
    through one task, which holds two hash states and a segment at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        wanted = ("conv_id", "turns", "loss", "n_turns", "loss_chars", "formatted_chars")
        for conv, rows in groupby(_rows(batches, *wanted), lambda r: r[0]):
            turns, loss, sums = hashlib.sha256(), hashlib.sha256(), np.zeros(3, np.int64)
            for _, turn, learned, *counts in rows:
                turns.update(turn)
                loss.update(learned)
                sums += counts
            n, chars, whole = sums.tolist()
            done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), whole))
            if len(done) == 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema)
                done = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema)

    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])
    dealt = read_back(segments, path).repartition("conv_id").sortWithinPartitions("conv_id", "block", "segment")
    kinds = {n: T.StringType() if "sha" in n else T.LongType() for n in names}
    return dealt.mapInArrow(run, T.StructType([T.StructField(n, k) for n, k in kinds.items()]))


#: The contract's own conversation, whose texts are control strings.
PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")
    path = byte_bpe.rank_file()
    return digests(formatted(rows.unionByName(planted), path), path)


def _escaped_sql(column: str) -> str:
    tags = f"regexp_replace({column}, '<(\\\\*/?s>)', '<\\\\\\1', 'g')"
    return f"regexp_replace({tags}, '\\[(\\\\*(?:/?INST|/?SYS|/?ROLE|NONE)\\])', '[\\\\\\1', 'g')"


ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
f AS (SELECT *, CASE WHEN role IS NULL THEN '<s>[NONE]' WHEN role = 'assistant' THEN '<s>' WHEN role = 'user' THEN '<s>[INST]'
    WHEN role = 'system' THEN '<s>[SYS]' ELSE '<s>[ROLE]' || {_escaped_sql('role')} || '[/ROLE]' END || {_escaped_sql('text')}
    || CASE role WHEN 'user' THEN '[/INST]' WHEN 'system' THEN '[/SYS]' ELSE '' END || '</s>' AS formatted FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
