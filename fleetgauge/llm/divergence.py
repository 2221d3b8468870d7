"""Source divergence audit: how far the word use of a language's sources lies apart.

Terms of every (lang, source) group are counted once. For the distance to the language, terms of
a group that share (group count, language count) are one cell: the measure is evaluated per cell,
cells of equal value merge, and cumulative multiplicities tell which of them reach the wanted
ranks; only those are expanded to terms. For the distance between two sources, sums over blocks of
terms are formed in cells of two blocks of sources, so that no pair is written per term.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pinned, spread_cells, table, whole_runs

# Fixed values of the contract: documents a kept term needs, pseudo-count, scale, ranks of terms.
LEAST_DOCUMENTS = 30
PSEUDO = 5
SCALE = 1_000_000_000
TOP_TERMS = 50

#: Terms of lower-cased UTF-8: letters a-z and every byte of a code point above ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_HELD = 400_000  # entries that a task holds before it passes them on
_LONG = 1 << 20  # bytes from which a text is counted term by term instead of as a list
_SOURCES, _TERMS = 64, 4096  # sources and terms of a block


def _texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 of each text, NULL as empty, one at a time."""
    raw = pa.array(column, pa.large_string()) if not pa.types.is_large_string(column.type) else column
    for value in raw.cast(pa.large_binary()):
        yield value.as_py() or b""


def _add(counts: Counter, documents: Counter, text: bytes) -> None:
    text = text.lower()  # of bytes: A-Z alone
    if len(text) < _LONG:
        found = _TERM.findall(text)
        counts.update(found)
        documents.update(set(found))
        return
    once = Counter(m.group() for m in _TERM.finditer(text))
    counts.update(once)
    documents.update(once.keys())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, documents) of a task's texts, added up while they fit, and one
    row with a NULL term per group that occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    marked: set[tuple[str, str]] = set()
    size = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, documents) in held.items():
            marker = [] if (lang, source) in marked else [None]
            marked.add((lang, source))
            terms = [*marker, *counts]
            n = [0] * len(marker) + list(counts.values())
            seen = [0] * len(marker) + [documents[t] for t in counts]
            if terms:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array([source] * len(terms)),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(seen, pa.int64())],
                    names=["lang", "source", "term", "n", "documents"],
                )

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, _texts(batch.column("text"))):
            if (lang, source) not in held:
                held[lang, source] = Counter(), Counter()
            counts, documents = held[lang, source]
            before = len(counts)
            _add(counts, documents, text)
            size += len(counts) - before
            if size > _HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, is_first): occurrences of each kept term in the group and in
    the language, is_first marking one row a term; plus a row with NULL term for every group.

    Text, lang and source of NULL count as ''. A term is kept in a language if `least` of its rows
    hold it. Rows are documents, repeated ones too; other columns play no part. An empty table gives
    no rows. A written table: texts are read once."""
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = named.mapInArrow(_counted, "lang string, source string, term string, n bigint, documents bigint")
    rows = rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    of_term = Window.partitionBy("lang", "term")
    rows = rows.withColumns({
        "lang_n": F.sum("n").over(of_term),
        "lang_documents": F.sum("documents").over(of_term),
        "is_first": F.row_number().over(of_term.orderBy("source")) == 1,
    })
    kept = rows.where(F.col("term").isNull() | (F.col("lang_documents") >= least))
    return pinned(kept.select("lang", "source", "term", "n", "lang_n", "is_first"))


def groups(counts: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, terms, place, sources): occurrences of kept terms in the
    group and the language, kept terms, and the group's place among the language's sources."""
    real = F.col("term").isNotNull()
    rows = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.sum((real & F.col("is_first")).cast("bigint")).alias("firsts")
    )
    of_lang = Window.partitionBy("lang")
    return rows.select(
        "lang", "source", "total",
        F.sum("total").over(of_lang).alias("lang_total"),
        F.sum("firsts").over(of_lang).alias("terms"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"),
        F.count(F.lit(1)).over(of_lang).alias("sources"),
    )


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE (n + PSEUDO) / (total + PSEUDO terms)), exact at every size; without any
    terms the divisor counts as 1, as nothing is summed over them."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + PSEUDO).cast("decimal(20,0)")
    bottom = F.greatest(F.lit(1), total + PSEUDO * terms).cast("decimal(20,0)")
    return F.call_function("div", top, bottom) + 1


def term_ranks(counts: DataFrame, stats: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): terms a group uses more than its language, the furthest
    first, to rank `top`. Equal values stand in the terms' UTF-8 order."""
    used = counts.where("term IS NOT NULL AND n > 0")
    cells = used.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("m"))
    cells = cells.join(stats, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.withColumn("value", p - q).where("value > 0").select("lang", "source", "n", "lang_n", "m", "value")
    of_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    values = values.withColumn("nth", F.row_number().over(of_group)).where(F.col("nth") <= top)
    ahead = F.sum("m").over(of_group.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("ahead", F.coalesce(ahead, F.lit(0))).where(F.col("ahead") < top)
    wanted = cells.join(values.select("lang", "source", "value", "ahead"), ["lang", "source", "value"]).drop("m")
    terms = used.join(wanted, ["lang", "source", "n", "lang_n"])
    in_value = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = terms.withColumn("nth", F.row_number().over(in_value)).where(F.col("nth") <= top)
    rank = (F.col("ahead") + F.col("nth")).cast("int")
    return terms.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= top)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """One table per cell."""
    for some in whole_runs(batches, "cell"):
        keys = some.column("cell").to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(edges, edges[1:]):
            yield some.slice(start, end - start).combine_chunks()


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each cell: sum over its terms of |p_a - p_b| beyond |base_a - base_b|, for the pairs of its
    sources: all of one block, or those across two. Rows without a term are the cell's sources with
    the p of an absent term."""
    for run in _cells(batches):
        term = run.column("term").combine_chunks()
        head = term.is_null().to_numpy(zero_copy_only=False)
        place, p, block = (run.column(c).to_numpy() for c in ("place", "p", "block"))
        order = np.argsort(place[head])
        places, base, side = place[head][order], p[head][order], block[head][order]
        names = run.column("source").filter(pa.array(head)).take(pa.array(order)).to_pylist()
        encoded = term.filter(pa.array(~head)).dictionary_encode()
        matrix = np.repeat(base[None], len(encoded.dictionary), axis=0)
        matrix[encoded.indices.to_numpy(), np.searchsorted(places, place[~head])] = p[~head]
        lang, terms, first = (run.column(c)[0].as_py() for c in ("lang", "terms", "chunk"))
        alone = side.min() == side.max() if len(side) else True
        for a in range(len(places)):
            far = np.abs(base - base[a])
            total = np.abs(matrix - matrix[:, a : a + 1]).sum(0) - len(matrix) * far
            if first == 0:  # all terms at the base's distance, said once
                total = total + terms * far
            others = np.flatnonzero(np.arange(len(places)) != a if alone else side != side[a])
            if len(others):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(others)), pa.array([names[a]] * len(others)),
                     pa.array([names[b] for b in others]), pa.array(total[others], pa.int64())],
                    names=["lang", "source", "item", "value"],
                )


def pair_ranks(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language by the distance of
    their word use, the furthest first, equal ones in UTF-8 order.

    Sources are cut into blocks of 64, terms into blocks of about 4,096; a task's cell holds two
    blocks of sources and one of terms whatever the sizes, and writes one row a pair of sources."""
    sized = stats.withColumns({
        "block": F.floor(F.col("place") / _SOURCES).cast("int"),
        "blocks": F.ceil(F.col("sources") / _SOURCES).cast("int"),
        "chunks": F.greatest(F.lit(1), F.ceil(F.col("terms") / _TERMS)).cast("int"),
    }).where("sources > 1")
    real = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(sized, ["lang", "source"])
    real = real.withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
    heads = sized.withColumns({"term": F.lit(None).cast("string"), "n": F.lit(0).cast("bigint")})
    heads = heads.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = real.unionByName(heads)
    rows = rows.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.withColumn("cell", F.xxhash64("lang", low, high, "chunk"))
    rows = rows.select("cell", "lang", "source", "term", "place", "block", "p", "terms", "chunk")
    found = spread_cells(rows, "lang", "term").mapInArrow(_distances, "lang string, source string, item string, value bigint")
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return found.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of `docs` (text, lang, source): part
    `pair` ranks the language's other sources, part `term` the group's typical terms.

    A language with one source has no pairs; without kept terms all its pairs have value 0."""
    counts = term_counts(docs, least)
    stats = groups(counts)
    both = pair_ranks(counts, stats).withColumn("part", F.lit("pair")).unionByName(
        term_ranks(counts, stats, top).withColumn("part", F.lit("term"))
    )
    return both.select("lang", "source", "part", "item", "value", "rank")


def query(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


_P = "1 + ({scale}::HUGEINT * ({n} + {a})) // ({total} + {a} * v)"


def _share_sql(n: str, total: str) -> str:
    return _P.format(scale=SCALE, n=n, total=total, a=PSEUDO)


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
l AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, l.term, l.ln, coalesce(x.n, 0) AS n FROM g JOIN l ON g.lang = l.lang
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY 1, 2, 3) x
    ON x.lang = g.lang AND x.source = g.source AND x.term = l.term),
t AS (SELECT lang, source, sum(n) AS total, sum(ln) AS lang_total, count(*) AS v FROM c GROUP BY 1, 2),
p AS (SELECT c.lang, c.source, term, n, {_share_sql('n', 'total')} AS p, {_share_sql('ln', 'lang_total')} AS q
  FROM c JOIN t ON t.lang = c.lang AND t.source = c.source),
pairs AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(s.value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT a.lang, a.source AS a, b.source AS b, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term GROUP BY 1, 2, 3) s
    ON s.lang = g.lang AND s.a = g.source AND s.b = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
