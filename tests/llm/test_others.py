import math
from collections import defaultdict

import numpy as np
import pytest
import tiktoken

import duckdb
from fleetgauge.llm import byte_bpe, mixing, neighbours, pages, urls


def _tokenizer():
    import public_tokenizers as P

    ranks = byte_bpe.load_ranks(byte_bpe.rank_file())
    return ranks, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library():
    ranks, library = _tokenizer()
    rng = np.random.default_rng(5)
    letters = np.array(list("'  \t\nstrevlmdLL09a!?é漢 　²x’\r\u0085🙂"))
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(4000)]
    texts += ["", "a\0b", "x" * 3000, "ab " * 2000 + " ", "'re" * 300, "<|endoftext|>", "\n" * 700]
    got = [i for group in byte_bpe._groups(texts, 500) for i in byte_bpe.encode_texts(group, byte_bpe.Merger(ranks))]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_bpe_round_trip_and_odd_rows(spark):
    ranks, library = _tokenizer()
    rows = [(1, "Hello  wörld's end\n", 1), (2, None, 2), (2, "", 3), (None, "é" * 999, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded int")
    path = byte_bpe.rank_file()
    encoded = byte_bpe.encode(docs, path)
    for r in byte_bpe.decode(encoded, path).collect():
        raw = (r.text or "").encode()
        assert bytes(r.decoded) == raw and r.ids == library.encode_ordinary(r.text or "")
        assert r.offsets == [0, *np.cumsum([len(library.decode_single_token_bytes(i)) for i in r.ids]).tolist()][:-1]
    assert byte_bpe.digests(docs.drop("decoded").limit(0), path).count() == 0
    assert byte_bpe.digests(docs, path).where("n_tokens = 0").count() == 2


def test_scan_of_blocks_equals_a_loop():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 9, 70_000)
    states = byte_bpe._starting_states(byte_bpe._OF_SYMBOL[symbols])
    state = byte_bpe.START
    for symbol, given in zip(symbols, states):
        assert given == state
        state = byte_bpe.NEXT[state, symbol]


def _fill(words, weights, most):
    """Water filling round by round."""
    names = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, total = {}, set(names), sum(words.values())
    while left:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > most * words[s] + 1e-9}
        if not over:
            return target | share
        target |= {s: most * words[s] for s in over}
        left -= over
    return target


def test_mix_targets_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))), str(rng.choice(["a", "b", "c", "d"], p=[0.9, 0.05, 0.04, 0.01]))) for i in range(3000)]
    rows += [(9000, None, "a"), (9001, "x y", None), (None, "p q r", "b"), (9002, "", "empty"), (9001, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", mixing.F.lit("clash"))
    found = mixing.sampled(docs).collect()
    again = mixing.sampled(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id or -1, r.source or "", r["size"], r.copies)
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(rows)
    words, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        words[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.copies <= 3
    expected = _fill(words, (1, 2, 3), 3.0)
    for r in found:
        assert math.isclose(r.target, expected[r.source], abs_tol=1e-6) and r.source_size == words[r.source]
    for s in words:
        assert abs(taken[s] - expected[s]) <= 3 * largest[s] + 1
    assert mixing.mixed(docs).count() == sum(r.copies for r in found)
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_mix_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    expected = con.execute(mixing.ORACLE)
    names = [d[0] for d in expected.description]
    got = mixing.query(spark, "/root/testdata/sf0.01").select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())


@pytest.mark.parametrize("shard", [16_384, 300])
def test_neighbours_recall(spark, shard):
    rng = np.random.default_rng(4)
    x = np.r_[rng.standard_normal((900, 24)), np.repeat(rng.standard_normal((3, 24)), 100, axis=0) + 0.01 * rng.standard_normal((300, 24))]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [float("inf")] * 24), (5060, [1.0] * 3), (0, x[0].tolist()), (None, x[1].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    graphs = neighbours.pinned(neighbours.index(df, shard))
    got = defaultdict(list)
    for r in neighbours.nearest(df.where("vec_id % 20 = 0"), graphs).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 1200, 20))
    hits = []
    for q, found in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        order = sorted(range(len(x)), key=lambda i: (-score[i], i))[:20]
        hits.append(len({v for v, _ in found} & set(order)) / 20)
        assert np.allclose([s for _, s in found], [score[v] for v, _ in found]) and len(found) == 20
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
    assert np.mean(hits) >= 0.9
    assert neighbours.nearest(df.limit(0), graphs).count() == 0


def test_main_text():
    page = """<html><head><title>T</title><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
    <nav><a href=/x>Home</a></nav><div class="ad">Buy now</div><article><h1>A &amp; B</h1><p>First <b>bold</b>
    text.</p><!-- <p>no</p> --><aside>side</aside><p>Second<br>line &lt;i&gt;</p><div class="comments"><p>me too</p></div>
    </article><form>Name <input></form><div id="cookie-notice">We use cookies</div><footer>&copy; x</footer></body></html>"""
    assert pages.main_text(page) == "A & B\nFirst bold text.\nSecond line <i>"
    assert pages.main_text(None) == "" and pages.main_text("") == "" and pages.main_text("<p") == ""
    assert pages.main_text("<article><p>" + "a " * 50_000 + "</p><p>one</article>").count("a") == 50_000
    plain = "<body><ul><li><a href=a>Home</a><li><a href=b>News</a></ul><p>" + "word " * 40 + "<p>" + "more " * 30 + "</body>"
    assert pages.main_text(plain) == ("word " * 40).strip() + "\n" + ("more " * 30).strip()


def test_pages_of_the_table(spark):
    import html
    import re

    rows = {r.page_id: r for r in pages.query(spark, "/root/testdata/sf0.01").collect()}
    for id, page in duckdb.sql("select page_id, html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[a-z/][^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert rows[id].text == "\n".join(p for p in parts if p) and rows[id].n_chars == len(rows[id].text)


def test_url_rules_and_links(spark):
    rows = [
        (1, "http://Good.com/a", "<a href='https://b.org/x'>"), (2, "https://b.org/", "<a href=//c.org>"),
        (3, "http://c.org", "<a href='http://bad.net/es/z'><a href='http://bad.net/es/z'>"), (4, "http://bad.net/es/q", None),
        (5, None, "x"), (6, "nothing", ""), (7, "a://WWW.example.com/en/x?y", ""), (8, "http://x.example.com/en/", ""),
        (9, "http://example.com/en", ""), (10, "http://d.org/", "<a href='http://b.org'>"), (4, "http://bad.net/es/q", None),
        (11, "http://bad.net/de/", ""), (12, "http://net/es/#f", ""), (13, "http://e.org/a://b.com/", ""),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", urls.F.lit(1))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judged(df).orderBy("page_id").collect()]
    assert got == [
        (1, "good.com", "/a", "com/", "allow"), (2, "b.org", "/", None, "block"), (3, "c.org", "", None, "block"),
        (4, "bad.net", "/es/q", "net/es/", "block"), (4, "bad.net", "/es/q", "net/es/", "block"), (5, "", "", None, "allow"),
        (6, "", "", None, "allow"), (7, "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        (8, "x.example.com", "/en/", "example.com/en/", "block"), (9, "example.com", "/en", "com/", "allow"),
        (10, "d.org", "/", None, "block"), (11, "bad.net", "/de/", None, "allow"), (12, "net", "/es/", "net/es/", "block"),
        (13, "e.org", "/a://b.com/", None, "allow"),
    ]
    assert urls.judged(df.limit(0)).count() == 0


def test_rank_equals_power_iteration(spark):
    rng = np.random.default_rng(6)
    weight = rng.integers(0, 3, (12, 12)) * (1 - np.eye(12, dtype=int))
    edges = [(f"h{i}", f"h{j}", int(weight[i, j])) for i, j in zip(*np.nonzero(weight))]
    links = spark.createDataFrame(edges, "source string, target string, weight long")
    seeds = spark.createDataFrame([("h0", 0.75), ("h1", 0.25)], "host string, seed double")
    share = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1)
    rank = seed = np.array([0.75, 0.25] + [0.0] * 10)
    for _ in range(200):
        rank = 0.15 * seed + 0.85 * rank @ share
    got = {r.host: r["rank"] for r in urls.spread(links, seeds).collect()}
    assert np.allclose([got.get(f"h{i}", 0) for i in range(12)], rank, atol=1e-5)
