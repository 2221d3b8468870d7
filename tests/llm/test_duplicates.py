import random
import re

import duckdb
import numpy as np
import pytest
import xxhash

from fleetgauge.llm import common, components, embedding_dedup, lines, simhash

WORD = re.compile(common.WORD)


def _groups(n, pairs):
    a, b = (np.array([p[k] for p in pairs], int) for k in (0, 1))
    return common.smallest_labels(a, b, n)


def _fingerprint(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "low long, high long")).collect()
    assert {r.node: r.component for r in found} == {**{i: 0 for i in range(1, 201)}, 501: 500, 502: 500}
    assert components.components(spark.createDataFrame([], "low long, high long")).count() == 0


def test_simhash_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.query(spark, path).collect()}
    rows = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet' order by 1").fetchall()
    prints = [_fingerprint(t, 4) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = _groups(len(rows), near)
    assert got == {(d, f"{p:016x}", rows[label[i]][0]) for i, ((d, _), p) in enumerate(zip(rows, prints))}


@pytest.mark.parametrize("part", [2048, 50])
def test_trie_join_finds_all_groups(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "_CELL", part)
    rng = np.random.default_rng(1)
    values = np.repeat(rng.integers(0, 1 << 63, 60, dtype=np.uint64), 20)
    for _ in range(4):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, len(values)).astype(np.uint64))
    values = np.unique(values)
    a, b = np.nonzero(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4, 1))
    label = common.smallest_labels(a, b, len(values))
    signed = values.view(np.int64).tolist()
    rows = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = {r.node: r.component for r in components.components(simhash.links(rows, 4)).collect()}
    ours, theirs = {}, {}
    for i, v in enumerate(signed):
        ours.setdefault(found.get(v, v), set()).add(v)
        theirs.setdefault(int(label[i]), set()).add(v)
    assert {frozenset(x) for x in ours.values()} == {frozenset(x) for x in theirs.values()}


def test_simhash_odd_rows(spark):
    rows = [(1, "a b c", 1), (1, "a b c", 2), (3, "A B C", 3), (2, None, 4), (4, "", 5), (None, " \t", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print__ int")
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b c"), (2, None)]
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def test_simhash_tells_rows_without_an_id_apart_by_text(spark):
    rows = [(None, "one two three"), (None, "four five six"), (None, "four five six"), (4, "a b"), (4, "c d"), (5, ""), (6, None), (7, "A B")]
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted(((r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert found == [(0, "four five six"), (0, "one two three"), (4, "a b"), (4, "c d"), (5, "")]


def test_simhash_groups_of_null_ids_and_empty_tables(spark):
    rows = [(None, "a b c"), (None, "A b C"), (None, "q r s"), (9, "q r s"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.component or 0) for r in simhash.grouped(docs, "bits", "component").collect())
    assert found == [(0, 0), (0, 0), (0, 0), (0, 0), (0, 9), (9, 9)]
    assert simhash.grouped(docs.limit(0), "bits", "component").count() == 0


def test_simhash_keeps_one_of_each_group(spark):
    """As brute force over fingerprints, on the given documents and planted edits."""
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet' order by 1").fetchall()
    rows += [(10_000 + i, t + " end") for i, t in rows[:40]]
    prints = [_fingerprint(t, 4) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    label = _groups(len(rows), near)
    kept = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({rows[label[i]][0] for i in range(len(rows))})


def _gone(rows, t=0.8):
    seen, gone = {}, set()
    for id, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = frozenset(WORD.findall(line))
            if not words:
                continue
            hit = words in seen or any(len(words & u) >= t * len(words | u) - 1e-9 for u in seen)
            seen[words] = True
            if hit:
                gone.add((id, k))
    return gone


@pytest.mark.parametrize("part", [20_000, 5])
def test_line_dedup_equals_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(lines, "_ROWS_OF_WORD", part)
    rng = random.Random(3)
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(1, 14))] for _ in range(50)]
    rows = []
    for i in range(200):
        text = []
        for _ in range(rng.randint(0, 5)):
            words = list(rng.choice(base))
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice("abcdefgh")
            text.append(" ".join(words))
        rows.append((i, "\n".join(text)))
    found = lines.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.id, k) for r in found for k in r.lines} == _gone(rows)


def test_line_dedup_on_documents(spark):
    rows = duckdb.sql("select doc_id, text from '/root/testdata/sf0.001/documents.parquet'").fetchall()
    gone = _gone(rows)
    expected = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}
    got = {r.doc_id: r.text for r in lines.query(spark, "/root/testdata/sf0.001").collect()}
    assert got == expected


def test_line_dedup_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lines, "_PIECE", 64)
    long = "x " * 5000 + "\n\n" + "y" * 500
    rows = [(1, "a b c\nx", 3), (1, "a b c\nx", 3), (None, "a b c\nq", 0), (2, None, None), (3, "", 0), (4, long, 0), (5, long, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {(r.doc_id, r.text) for r in lines.deduplicated(docs).collect()}
    assert got == {(1, "a b c\nx"), (None, "q"), (2, None), (3, ""), (4, "\n" + "y" * 500), (5, "")}
    assert lines.deduplicated(docs.limit(0)).count() == 0


def test_line_dedup_keeps_unique_lines_of_shared_and_missing_ids(spark):
    rows = [(1, "x y z"), (None, "a b c\nx y z"), (None, "q r s\nunique words here"), (7, "k l m\nx y z"), (7, "n o p\nonly in this"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in lines.deduplicated(docs).collect())
    assert got == [(0, "a b c"), (0, "q r s\nunique words here"), (1, "x y z"), (7, ""), (7, "k l m"), (7, "n o p\nonly in this")]


def test_line_dedup_compares_lines_at_the_same_place_of_rows_that_share_an_id(spark):
    rows = [(None, "same words here"), (None, "same words here\nmore to say")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.text for r in lines.deduplicated(docs).collect())
    assert got in (["", "same words here\nmore to say"], ["more to say", "same words here"])


def test_line_dedup_of_texts_with_many_similar_lines(spark):
    many = ["\n".join(f"all these lines are alike but for number {k} of text{d}" for k in range(20_000)) for d in (1, 2)]
    docs = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.deduplicated(docs, 0.95).collect()}
    assert got[0] == many[0] and got[1] == many[1]
    got = {r.doc_id: r.text for r in lines.deduplicated(docs.union(docs.selectExpr("doc_id + 2", "text")), 0.95).collect()}
    assert (got[0], got[1], got[2], got[3]) == (many[0], many[1], "", "")


@pytest.mark.parametrize("part", [2048, 40])
def test_embedding_links_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "_PART", part)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((30, 20))
    x = np.repeat(centre, 8, axis=0) + 0.22 * rng.standard_normal((240, 20))
    label = rng.integers(0, 3, 240)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    odd = [(1000, None, 1), (1001, [0.0] * 20, 1), (1002, [float("nan")] * 20, 1), (1003, [1.0, None], 1), (1004, x[0].tolist(), None), (1005, [1.0, 2.0], 1), (0, x[0].tolist(), int(label[0]))]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    component = common.smallest_labels(*np.nonzero(near), 240)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.deduplicated(df).collect()}
    expected = {i: (int(near[i].sum()), int(component[i]), bool(component[i] == i)) for i in range(240)}
    assert near.sum() > 100
    assert got == {**expected, **{i: (0, i, True) for i in range(1000, 1006)}}
    assert embedding_dedup.deduplicated(df.limit(0)).count() == 0
