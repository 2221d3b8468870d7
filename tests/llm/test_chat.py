import base64
import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import check
from fleetgauge.llm import byte_bpe, chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
HARD = ["", "plain words", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST][/ROLE", "<", "[", "<<s>>", "s> [/INST]s]",
        " \n lead and trail \n ", "naïve 漢字 🙂[SYS]", "<s", "[s>", "\\", "[\\\\NONE]", "don't　stop"]


@pytest.fixture(scope="module")
def path():
    return byte_bpe.rank_file()


@pytest.fixture(scope="module")
def library(path):
    import public_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = {c: len(ranks) + i for i, c in enumerate(chat.CONTROLS)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def conversations(seed, n):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", None, "tool", "[ROLE]", ""]
    return [(c, t, draw.choice(roles), draw.choice([None, *HARD, "".join(draw.choices("<>[]/\\sINTOK ", k=40))]))
            for c in range(n) for t in range(draw.randint(1, 9))]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""), r[3] or ""))
        learned = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        out[conv] = (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def found(spark, rows, path):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r[0]: tuple(r)[1:5] for r in chat.digests(chat.formatted(df, path), path).collect()}


@pytest.mark.parametrize("text", HARD)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    for _ in range(3):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)
        text = escaped


def test_rendered_turns_are_read_back():
    draw = random.Random(5)
    for _ in range(300):
        turns = [(draw.choice(["user", "assistant", "system", None, "x", "[/ROLE]", ""]), draw.choice(HARD)) for _ in range(draw.randint(0, 6))]
        text, spans = chat.render(turns)
        assert list(chat.parse(text)) == turns
        assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_tokens_offsets_and_mask_equal_the_library(spark, path, library):
    rows = conversations(1, 40)
    segments = chat.formatted(spark.createDataFrame(rows, SCHEMA), path).collect()
    assert len(segments) == 40
    for row in segments:
        ids = library.encode(row["formatted"], allowed_special="all")
        assert row["ids"] == ids
        raw = [library.decode_single_token_bytes(i) for i in ids]
        assert row["offsets"] == np.r_[0, np.cumsum([len(r) for r in raw])][:-1].tolist()
        learned = b"".join(r for r, m in zip(raw, row["loss_mask"]) if m).decode()
        turns = list(chat.parse(row["formatted"]))
        assert learned == "".join(chat.escape(t) for role, t in turns if role == "assistant")


def test_mask_by_search_equals_every_token_looked_at():
    draw = np.random.default_rng(2)
    for _ in range(200):
        edges = np.r_[0, np.cumsum(draw.integers(1, 4, 30))]
        cuts = np.sort(draw.choice(edges, 2 * draw.integers(0, 6), replace=False)).reshape(-1, 2)
        cuts = np.insert(cuts, len(cuts), [edges[-1], edges[-1]], axis=0)  # an empty text at the end
        want = [any(a <= x and y <= b for a, b in cuts) for x, y in zip(edges, edges[1:])]
        assert chat.masked(edges[:-1], edges[-1], cuts).tolist() == want


def test_digests_equal_brute_force(spark, path):
    rows = conversations(2, 60) + [(None, 1, "assistant", "a"), (None, None, "user", None), (None, 1, "assistant", "a")]
    assert found(spark, rows, path) == expected(rows)


def test_long_conversations_are_cut_into_segments(spark, path, monkeypatch):
    rows = [(7, t, "assistant" if t % 2 else "user", f"turn {t} " + "é" * (t % 50)) for t in range(1500)]
    rows += [(8, 0, "assistant", "word " * 500_000), (8, 1, "user", "[INST]" * 100_000)]
    segments = chat.formatted(spark.createDataFrame(rows, SCHEMA), path)
    per = {r[0]: r[1] for r in segments.groupBy("conv_id").count().collect()}
    assert per == {7: 3, 8: 2}
    assert found(spark, rows, path) == expected(rows)


def test_empty_table_and_clashing_columns(spark, path):
    df = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.formatted(df, path), path).collect() == []
    rows = conversations(3, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("block", "segment", "formatted", "ids", "loss_mask"):
        df = df.withColumn(name, F.lit("clash"))
    assert {r[0]: tuple(r)[1:5] for r in chat.digests(chat.formatted(df, path), path).collect()} == expected(rows)


def test_query_and_sql_agree_on_hard_texts(spark, tmp_path):
    rows = conversations(4, 50)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert check.compare(chat.query(spark, str(tmp_path)), con, chat.ORACLE) == "ok 51 rows"
