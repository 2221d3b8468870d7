"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge import session

#: A word is a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "spark.sql.parquet.compression.codec"


def pinned(df: DataFrame, codec: str | None = None) -> DataFrame:
    """A table in the shared folder, as `session.pinned`; the shuffle files of its job go with it,
    since nothing else reads them, so that the steps of an operator don't add up on disk. `codec`:
    that of its files, else the session's."""
    conf = df.sparkSession.conf
    before, files = conf.get(_CLEANUP, "false"), conf.get(_CODEC)
    conf.set(_CLEANUP, "true")
    conf.set(_CODEC, codec or files)
    try:
        return session.pinned(df)
    finally:
        conf.set(_CLEANUP, before)
        conf.set(_CODEC, files)


def removed(spark, df: DataFrame) -> None:
    """Delete the files of a `pinned` table that nothing reads any more."""
    context = spark.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        at = context._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Working names that no column of `df` has, so that extra columns never clash."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo `n`; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % n


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup sorted batches so that all rows of one `key` value arrive in one table.

    Holds at most one batch and one run; callers bound the run length."""
    held: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = pa.Table.from_batches([batch])
        keys = part.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        start = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
        if start:
            yield pa.concat_tables([*held, part.slice(0, start)]).combine_chunks()
            held = []
        held.append(part.slice(start))
    if held:
        yield pa.concat_tables(held).combine_chunks()


@lru_cache(1)
def _trim():
    """glibc's malloc_trim, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over batches, giving back the memory that it has freed at its end: a Python worker serves
    many tasks, and what its allocators keep would add to those of the stages that follow."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return wrapped


def pair_cells(df: DataFrame, keys: list[str], row_id: str, limit: int) -> DataFrame:
    """Cut each group of `keys` into parts of about `limit` rows and send every part to the
    cells in which it meets the others: columns `cell` (bigint) and `part`.

    A group of k parts has k(k+1)/2 cells of at most two parts, so that a hot group becomes
    many tasks and no task holds a group. Within a cell, rows of two parts meet across, rows of
    a single part among themselves."""
    counts = df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / limit).cast("int").alias("parts"))
    rows = df.join(counts, keys).withColumn("part", F.pmod(F.xxhash64(F.lit(7), F.col(row_id)), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64(*keys, F.least("part", "other"), F.greatest("part", "other"))
    return (
        rows.withColumn("cell", cell)
        .withColumn("alone", F.col("part") == F.col("other"))
        .drop("parts", "other")
    )


def spread_cells(df: DataFrame, *order: str) -> DataFrame:
    """Deal rows out by cell, sorted so that `whole_runs` can follow."""
    return df.repartition("cell").sortWithinPartitions("cell", *order)


def smallest_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of `n` nodes over the edges a-b."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if np.array_equal(label, before):
            return label
