"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fleetgauge", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a scratch one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="fleetgauge-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: later plans reuse it and its
    lineage ends there, also when an executor is lost."""
    path = scratch_path(df.sparkSession, "pinned")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evenly(df: DataFrame, n: int, rows: int = 250_000) -> DataFrame:
    """`df` of `n` rows dealt out evenly: one part a core at least, at most `rows` rows a part."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows)))
