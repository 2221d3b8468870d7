import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetgauge.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least, top):
    """Straight from the contract, term by term."""
    rows = [(t or "", la or "", s or "") for t, la, s in rows]
    out = []
    for lang in {r[1] for r in rows}:
        texts = [(s, TERM.findall(t.translate(LOWER))) for t, la, s in rows if la == lang]
        seen = Counter(w for _, ws in texts for w in set(ws))
        kept = sorted((w for w, n in seen.items() if n >= least), key=lambda w: w.encode())
        counts = {s: Counter(w for s2, ws in texts if s2 == s for w in ws if seen[w] >= least) for s, _ in texts}
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + 5 * len(kept)
            return {w: 1 + 10**9 * (c[w] + 5) // total for w in kept}

        q, p = shares(whole), {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in counts if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def audited(spark, rows, least=2, top=5):
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    return sorted(map(tuple, divergence.audit(docs, least, top).collect()))


def corpus(seed, n, sources, words):
    draw = random.Random(seed)
    vocabulary = [draw.choice("abcÄéЖ漢zZ") + draw.choice("xyzßQ") + str(draw.randint(0, 9)) + draw.choice("mnoP") for _ in range(words)]
    return [
        (" ".join(draw.choices(vocabulary, k=draw.randint(0, 30))), draw.choice(["en", "de"]), f"s{int(sources * draw.random() ** 2)}")
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_contract_term_by_term(spark, seed):
    rows = corpus(seed, 150, 6, 40)
    assert audited(spark, rows) == brute(rows, 2, 5)


def test_blocks_of_sources_and_terms_change_nothing(spark, monkeypatch):
    rows = corpus(3, 120, 9, 60)
    monkeypatch.setattr(divergence, "_SOURCES", 2)
    monkeypatch.setattr(divergence, "_TERMS", 7)
    assert audited(spark, rows) == brute(rows, 2, 5)


def test_nulls_empty_texts_ties_and_repeated_rows(spark):
    rows = [(None, "en", "a"), ("", "en", None), ("x y", None, "a"), ("x y", None, "a"), ("y x x", None, None),
            ("b a c", "en", "b"), ("c a b", "en", "b"), ("A\x00B é", "en", "a"), ("Ééa ÉÉA", "en", "c")]
    assert audited(spark, rows) == brute(rows, 2, 5)
    # one source has no pairs; groups without terms still take part in them
    assert {(r[1], r[3]) for r in audited(spark, rows) if r[0] == "en" and r[2] == "pair"} == {
        (a, b) for a in ("", "a", "b", "c") for b in ("", "a", "b", "c") if a != b}


def test_no_kept_terms_gives_pairs_of_value_zero(spark):
    rows = [("p", "en", "b"), ("q", "en", "a"), ("r", "en", "c")]
    assert audited(spark, rows, least=30) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "a", "pair", "c", 0, 2), ("en", "b", "pair", "a", 0, 1),
        ("en", "b", "pair", "c", 0, 2), ("en", "c", "pair", "a", 0, 1), ("en", "c", "pair", "b", 0, 2)]


def test_empty_table_clashing_columns_and_long_texts(spark, monkeypatch):
    assert audited(spark, []) == []
    rows = [("word " * 30000, "en", "a"), ("word other", "en", "b"), ("other", "en", "b")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    for name in ("term", "n", "p", "value", "cell", "place"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert sorted(map(tuple, divergence.audit(docs, 2, 5).collect())) == brute(rows, 2, 5)


def test_long_texts_are_counted_as_short_ones():
    whole, parts = (Counter(), Counter()), (Counter(), Counter())
    text = ("One two ÉÉ " * 120_000).encode()
    divergence._add(*whole, text)
    assert whole[0] == {b"one": 120_000, b"two": 120_000, "ÉÉ".encode(): 120_000}
    assert set(whole[1].values()) == {1}
    divergence._add(*parts, text[: 13 * 10])
    assert set(parts[0]) == {b"one", b"two", "ÉÉ".encode()}


def test_shares_are_exact_beyond_64_bits(spark):
    big = 20_000_000_000
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(3 * big + 1), F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (3 * big + 1 + 35)
