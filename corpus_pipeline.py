"""Corpus pipeline: documents to mixed, deduplicated, encoded training data.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as
the next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm import byte_bpe, lines, mixing, quality, simhash
from fleetgauge.session import pinned


def quality_filter(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier, trained on the labels, finds likelier bad than good."""
    return quality.accepted(docs, quality.trained(spark, sf_dir), threshold=0.5)


def line_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines that repeat an earlier one (Jaccard of their words at least 0.8)."""
    return lines.deduplicated(docs, threshold=0.8)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints (four-word shingles, 4 bits at most)."""
    return simhash.deduplicated(docs, width=4, budget=4)


def source_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some repeatedly, so that sources come near their target weights."""
    return mixing.mixed(docs)


def encoded(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text's own bytes (NULL texts: to none)."""
    path = byte_bpe.rank_file()
    digest = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    rows = docs.select("doc_id", "lang", "source", "text", digest.alias("digest"))
    ids = byte_bpe.encode(rows, path, cached=100_000)  # beside what earlier stages left in the workers
    tokens = byte_bpe.decode(ids.drop("text", "offsets"), path)
    same = F.sha2("decoded", 256) == F.col("digest")
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("restored"))


STAGES = [
    ("quality", quality_filter),
    ("lines", line_dedup),
    ("simhash", near_dedup),
    ("mixing", source_mix),
    ("byte_bpe", encoded),
]

#: SQL has neither the classifier nor the fingerprints; the stages are tested in tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
