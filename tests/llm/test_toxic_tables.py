import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from fleetgauge import session
from fleetgauge.llm import toxicity


def test_every_labelled_pair_is_counted_however_many(spark):
    """More distinct words and pairs than 2**19, most of them seen once."""
    n = 600_000
    word = F.concat(F.lit("w"), F.col("id").cast("string"))
    rows = spark.range(n).select((F.col("id") % 2).alias("label"), (F.col("id") / 100).cast("long").alias("doc"), word.alias("w"))
    texts = rows.groupBy("label", "doc").agg(F.concat_ws(" ", F.sort_array(F.collect_list("w"))).alias("text"))
    tables = toxicity.count_tables(texts.select("label", "text"))
    assert tables.words.count() == n and tables.pairs.count() == n
    assert tables.pairs.where("n0 + n1 <> 1 or n0 * n1 <> 0").count() == 0


def test_scores_equal_a_direct_sum_of_pairs(spark):
    labelled = [(0, "a b a c"), (0, "a b"), (1, "a d d"), (1, "e d a d")]
    tables = toxicity.count_tables(spark.createDataFrame(labelled, "label int, text string"))
    texts = ["a d a d zz a b", "A, d! a d zz a b", "zz", "", None, "e d d d d d"]
    docs = spark.createDataFrame([(k % 2, t) for k, t in enumerate(texts)] * 2, "doc_id int, text string").coalesce(1)
    got = {r.text: (r.whole, r.strong) for r in toxicity._measured(docs, tables, "text", ["whole", "strong"]).collect()}
    for text in texts:
        words, sizes = toxicity._words([text])
        diff = tables.difference(words, toxicity._before(words, sizes)) if len(words) else np.zeros(0)
        strong = np.log(np.maximum(diff - toxicity._STRONG, 0).sum() / (len(diff) + 10) + 0.001)
        assert np.allclose(got[text], (diff.sum() / max(1, len(diff)), strong))


def _by_hand(labelled, text):
    """Mean difference and excess of a text, by Kneser-Ney estimates in plain dictionaries of words."""
    d, grams = 0.75, [Counter(), Counter()]
    for label, line in labelled:
        words = line.split()
        grams[label].update(zip(["<s>", *words], words))
    every = set(grams[0]) | set(grams[1])
    size, after = len({w for _, w in every}) + 1, Counter(w for _, w in every)

    def probability(k, v, w):
        own = grams[k]
        total = sum(n for (a, _), n in own.items() if a == v)
        kinds = len([1 for a, _ in own if a == v])
        types = len({b for _, b in own})
        shared = (after[w] + 1) / (len(every) + size)
        alone = (max(len([1 for _, b in own if b == w]) - d, 0) + d * types * shared) / len(own)
        if not total:
            return alone, alone
        return max(own[v, w] - d, 0) / total + min(1, d * kinds / total) * alone, alone

    diffs, words = [], text.split()
    for v, w in zip(["<s>", *words], words):
        (p0, a0), (p1, a1) = probability(0, v, w), probability(1, v, w)
        both, alone = math.log(p1 / p0), math.log(a1 / a0)
        diffs.append(math.copysign(min(abs(both), abs(alone)), both) if both * alone > 0 else 0.0)
    excess = sum(max(x - 3.0, 0) for x in diffs)
    return sum(diffs) / max(1, len(diffs)), math.log(excess / (len(diffs) + 10) + 0.001)


def test_measures_equal_kneser_ney_by_hand(spark):
    draw = random.Random(3)
    vocabulary = [f"w{k}" for k in range(30)]
    labelled = [(0, " ".join(draw.choices(vocabulary[:24], k=draw.randint(1, 12)))) for _ in range(60)]
    labelled += [(1, " ".join(draw.choices(vocabulary[18:], k=draw.randint(1, 12)))) for _ in range(25)]
    tables = toxicity.count_tables(spark.createDataFrame(labelled, "label int, text string"))
    texts = [" ".join(draw.choices([*vocabulary, "unseen"], k=draw.randint(1, 20))) for _ in range(40)] + [""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: (r.whole, r.strong) for r in toxicity._measured(docs, tables, "text", ["whole", "strong"]).collect()}
    for text in texts:
        assert np.allclose(got[text], _by_hand(labelled, text), atol=1e-9), text


def _corpus(spark, texts, words):
    """Texts of words that follow each other in no order; nearly every pair is a new one."""
    word = F.transform(F.sequence(F.lit(1), F.lit(words)), lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), k), F.lit(20_000)).cast("string")))
    return spark.range(texts).select(F.xxhash64("id").alias("of"), F.array_join(word, " ").alias("text"))


def _on_disk(spark):
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_pairs_of_texts_are_no_rows_on_disk(spark):
    labelled = spark.createDataFrame([(0, "w1 w2"), (1, "w2 w1")], "label int, text string")
    tables = toxicity.count_tables(labelled)
    before = _on_disk(spark)
    found = toxicity.measures(_corpus(spark, 400, 500), tables)
    assert found.count() == 400
    assert _on_disk(spark) - before < 400 * 500


def test_measures_do_not_depend_on_slices_chunks_or_buckets(spark, monkeypatch):
    docs = _corpus(spark, 300, 40)
    labelled = docs.where("of % 3 = 0").select((F.pmod("of", F.lit(2))).alias("label"), "text")
    wanted = {r.of: (r.whole, r.strong) for r in toxicity.measures(docs, toxicity.count_tables(labelled)).collect()}
    for name, value in (("_SLICE", 1 << 14), ("_SLICES", 3), ("_CHUNK", 1 << 12), ("_LEAST_BITS", 2), ("_BUCKET_ROWS", 1000)):
        monkeypatch.setattr(toxicity, name, value)
    twice = docs.union(docs)
    found = {r.of: (r.whole, r.strong) for r in toxicity.measures(twice, toxicity.count_tables(labelled)).collect()}
    assert len(found) == 300 and found.keys() == wanted.keys()
    assert all(np.allclose(found[k], wanted[k]) for k in found)
