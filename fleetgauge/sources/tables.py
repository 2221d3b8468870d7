"""Readers and writers for sensor text, truth vectors, CSV batches and JSON artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from fleetgauge.functions.scalars import clip, nan_to_null
from fleetgauge.operators.rules import require_columns
from fleetgauge.schema import MAX_RUL, OPS, RISK_THRESHOLD, SENSORS, SPLITS, VARIANTS

READING_NAMES = ["unit_id", "cycle", *OPS, *SENSORS]


def checked_variant(variant: str) -> str:
    name = variant.upper()
    if name not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, got {variant!r}")
    return name


def readings_path(root: str, variant: str, split: str = "train") -> str:
    """Path of one variant's file after checking the arguments."""
    name = checked_variant(variant)
    if split not in SPLITS:
        raise ValueError(f"split must be one of {SPLITS}, got {split!r}")
    return f"{root.rstrip('/')}/{split}_{name}.txt"


def _variant_of_file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"(FD\d+)[^/]*(?:/[^/]*)?$", 1)


def read_text_readings(
    spark: SparkSession, path: str | list[str], names: Sequence[str] = READING_NAMES
) -> DataFrame:
    """Parse whitespace-separated readings; any run of blanks separates, names go left to right.

    All files are read in one pass and the variant comes from the file or folder name. Values
    that are absent or not numeric become NULL.
    """
    parts = F.split(F.trim(F.regexp_replace("value", r"[\s\t]+", " ")), " ")
    lines = spark.read.text(path).select(_variant_of_file().alias("variant"), parts.alias("_p"))

    def field(i: int, name: str) -> Column:
        kind = {"unit_id": "bigint", "cycle": "int"}.get(name, "double")
        text = F.get("_p", F.lit(i))
        value = text.try_cast("double")
        return value.try_cast(kind).alias(name)

    fields = [field(i, n) for i, n in enumerate(names)]
    parsed = lines.where(F.get("_p", F.lit(0)) != "").select("variant", *fields)
    return nan_to_null(parsed, [n for n in names if n not in ("unit_id", "cycle")])


def load_readings(spark: SparkSession, root: str, variants: Sequence[str], split: str = "train") -> DataFrame:
    """Readings of several variants; a missing file is an error when the plan is built."""
    return read_text_readings(spark, [readings_path(root, v, split) for v in variants])


def write_text_readings(
    df: DataFrame, path: str, sensors: Sequence[str], pad: bool = False
) -> None:
    """One folder per variant of blank-separated lines; `pad` adds the trailing blanks seen in
    such files."""
    values = [F.col(c).cast("string") for c in ("unit_id", "cycle", *sensors)]
    line = F.concat_ws("  " if pad else " ", *values)
    out = df.select(F.concat(line, F.lit("  " if pad else "")).alias("value"), "variant")
    out.write.partitionBy("variant").text(path)


def read_truth(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`(variant, unit_id, true_rul)` from one value per line; the unit is the number of the line,
    blank lines not counted.

    Lines are counted per file block, so large files are numbered without a single task.
    """
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        _variant_of_file().alias("variant"),
        F.monotonically_increasing_id().alias("_id"),
        F.trim("value").try_cast("double").alias("true_rul"),
    )
    counts = lines.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_file", "_start").orderBy("_id")
    numbered = lines.join(offsets, ["_file", "_start"]).withColumn(
        "unit_id", (F.col("_off") + F.row_number().over(inside)).cast("bigint")
    )
    return numbered.select("variant", "unit_id", "true_rul")


def write_truth(truth: DataFrame, path: str) -> None:
    """One file per variant with one value per line in unit order, the exchange format."""
    lines = truth.select("variant", "unit_id", F.col("true_rul").cast("string").alias("value"))
    (
        lines.repartition("variant")
        .sortWithinPartitions("variant", "unit_id")
        .select("variant", "value")
        .write.partitionBy("variant")
        .text(path)
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (*OPS, *SENSORS)
) -> DataFrame:
    """CSV with header and an explicit schema; missing required columns are refused up front."""
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    require_columns(df, required)
    return df


def batch_score(
    batch: DataFrame, risk: Column, target: str, rul: Column | None = None,
    threshold: float = RISK_THRESHOLD,
) -> None:
    """Add score columns to a batch and write parquet; other columns pass through."""
    estimate = clip(rul, 0.0) if rul is not None else clip((1.0 - risk) * MAX_RUL, 0.0)
    batch.withColumns(
        {
            "risk_score": clip(risk, 0.0, 1.0),
            "replace_within_30": risk >= threshold,
            "estimated_rul": estimate,
        }
    ).write.parquet(target)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """An artifact written before, or None where there is none."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(schema).json(path) if fs.exists(jvm_path) else None
