"""Mixing sources to target weights by systematic sampling, in DataFrame functions alone.

A source's documents share one expected number of copies, target / size. Documents stand in a
fixed order, by classes of similar size and a hash; the prefix sum of expected copies plus one
offset per source crosses integers, and a document is taken once for each that it crosses. So a
source's copies are right to one in every size class, and its words nearly so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, pinned, table

#: Documents counted together; a part of the order that one task sorts.
_ROWS = 256
_FINE = 1 << 16
_SEED = "mix"


def _hash(*parts: Column) -> Column:
    """32 bits of an MD5, as bigint."""
    text = F.concat_ws("|", F.lit(_SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _level(size: Column) -> Column:
    """Class of similar sizes: eight to a doubling."""
    return F.floor(8 * F.log2(size + F.lit(1))).cast("int")


def targets(sources: DataFrame, weights: tuple[int, ...], most: float) -> DataFrame:
    """`sources` (source, words) with `target`: all words shared by weight, no target above `most`
    times its source's words, the excess shared again by weight.

    Sources in code-point order, NULL last, take the weights in turn. In the order of cap per
    weight, capped sources come first, so one pass of running sums finds the level."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    rows = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1))
    rows = rows.withColumn("cap", F.lit(most) * F.col("words"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everywhere = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("words").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    shares = F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("level", left / shares)
    rows = rows.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everywhere)
    return rows.select(
        "source", "words", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level["level"]).alias("target")
    )


def sampled(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0,
    copies: str = "copies", size: str = "size", source_size: str = "source_size", target: str = "target",
) -> DataFrame:
    """`docs` (doc_id, text, source and more) with its size in words, its source's words and
    target, and the number of copies taken (0 to ceil(most)).

    A NULL text has size 0, a NULL source is a source. Rows alike in source, size, doc_id and text
    are interchangeable. Columns of the four given names are replaced. Everything is a hash of
    ids and texts, so runs agree. Counts by size class and hash are gathered once; a hot source or
    class is sorted in parts of about 256 documents."""
    rest = [c for c in docs.columns if c not in (copies, size, source_size, target)]
    docs = docs.select(*rest)
    words, src, level, fine, part, place = fresh(docs, "words__", "src__", "level__", "fine__", "part__", "place__")
    rows = docs.withColumn(words, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    rows = rows.withColumn(src, F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")))
    rows = rows.withColumn(level, _level(F.col(words))).withColumn(fine, F.floor(_hash(F.col("doc_id")) / _FINE).cast("int"))

    counts = pinned(
        rows.groupBy(F.col(src).alias("src"), F.col(level).alias("level"), F.col(fine).alias("fine"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(words).alias("words"))
    )
    sources = counts.groupBy("src").agg(F.sum("words").alias("words"))
    sources = sources.select(F.when(~F.col("src.none"), F.col("src.name")).alias("source"), "words")
    aims = targets(sources, weights, most)
    aims = aims.select(
        F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")).alias("src"),
        F.col("words").alias("source_words"), "target",
        F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0)).alias("rate"),
        (F.floor(_hash(F.lit("offset"), F.col("source")) / _FINE) / _FINE).alias("offset"),
    )
    levels = counts.groupBy("src", "level").agg(F.sum("n").alias("n"))
    levels = levels.withColumn("parts", F.least(F.lit(_FINE), F.ceil(F.col("n") / _ROWS)).cast("int"))
    ahead = Window.partitionBy("src").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    levels = pinned(levels.join(aims, "src").drop("n"))
    within = Window.partitionBy("src", "level").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.join(levels.select("src", "level", "parts", "ahead"), ["src", "level"])
    parts = parts.withColumn("part", F.floor(F.col("fine") * F.col("parts") / _FINE).cast("int"))
    parts = parts.groupBy("src", "level", "part", "ahead").agg(F.sum("n").alias("n"))
    parts = pinned(parts.select("src", "level", "part", (F.col("ahead") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("start")))

    def named(df: DataFrame, *kept: str) -> DataFrame:
        """Columns under names that clash with none of the documents'."""
        names = dict(zip(["src", "level", "part"], [src, level, part]))
        return df.select(*[F.col(c).alias(names.get(c, f"{c}{place}")) for c in kept])

    rows = rows.join(named(levels, "src", "level", "parts", "source_words", "target", "rate", "offset"), [src, level])
    rows = rows.withColumn(part, F.floor(F.col(fine) * F.col(f"parts{place}") / _FINE).cast("int"))
    inside = Window.partitionBy(src, level, part).orderBy(words, fine, "doc_id", F.md5(F.coalesce("text", F.lit(""))))
    rows = rows.withColumn(place, F.row_number().over(inside))
    rows = rows.join(named(parts, "src", "level", "part", "start"), [src, level, part])
    at, rate, offset = F.col(place) + F.col(f"start{place}"), F.col(f"rate{place}"), F.col(f"offset{place}")
    taken = F.floor(offset + at * rate) - F.floor(offset + (at - 1) * rate)
    return rows.select(
        *rest, F.col(words).alias(size), F.col(f"source_words{place}").alias(source_size),
        F.col(f"target{place}").alias(target), taken.cast("long").alias(copies),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """The mix itself: each document once per copy, with the columns of `docs`."""
    names = fresh(docs, "copies__", "size__", "source_size__", "target__")
    rows = sampled(docs, weights, most, *names).where(F.col(names[0]) > 0)
    (copy,) = fresh(docs, "copy__")
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(names[0]).cast("int")))).select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return sampled(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5('{_SEED}|' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT // {_FINE})::INTEGER AS fine
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3.0::DOUBLE * words AS cap FROM s),
l AS (
  SELECT *, (sum(words) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w),
t AS (
  SELECT source, words, CASE WHEN cap <= level * weight THEN cap
    ELSE weight * (SELECT arg_min(level, cap / weight) FROM l WHERE cap > level * weight) END AS target,
    (('0x' || substr(md5('{_SEED}|offset|' || coalesce(source, '')), 1, 8))::BIGINT // {_FINE}) / {_FINE}.0::DOUBLE AS off
  FROM l),
e AS (SELECT *, floor(8 * log2(size + 1))::INTEGER AS level FROM d),
c AS (SELECT *, least({_FINE}, ceil(count(*) OVER (PARTITION BY source, level) / {_ROWS}.0))::INTEGER AS parts FROM e),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY level, fine * parts // {_FINE}, size, fine, doc_id, md5(coalesce(text, ''))) AS place FROM c)
SELECT p.doc_id, p.size, t.words AS source_size, t.target,
  (floor(off + place * rate) - floor(off + (place - 1) * rate))::BIGINT * p.size AS taken
FROM p JOIN (SELECT *, CASE WHEN words > 0 THEN target / words ELSE 0 END AS rate FROM t) t ON p.source IS NOT DISTINCT FROM t.source
"""
