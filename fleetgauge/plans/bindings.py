"""Views that read the driver's tables as fleets of machines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetgauge.functions.ordering import numbered, oversized
from fleetgauge.operators.labels import add_binary_label, add_rul
from fleetgauge.session import pinned

FLEET_SENSORS = ["sensor_1", "sensor_2", "sensor_3"]
WIDE_SENSORS = ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]
WIDE_ORDER = [
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


class Fleet(NamedTuple):
    """A reading frame and whether any unit is too large for one task. Cycles count 1, 2, ...

    A fleet with such a unit is numbered once and kept as a table in the shared folder."""

    df: DataFrame
    hot: bool


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fleet(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> Fleet:
    """`events` as readings: a user is a unit, its events in time order are cycles.

    The user's own column becomes the unit, without a cast, so that windows over (variant, unit) find
    the rows dealt out by the exchange that numbered them."""
    events = table(spark, sf_dir, "events")
    hot = oversized(events, ["user_id"])
    ordered = numbered(events, ["user_id"], ["ts", "event_id"], "_cycle", hot=hot)
    df = ordered.select(
        F.concat(F.lit("FD00"), (F.lit(1) + F.col("user_id") % 4).cast("string")).alias("variant"),
        F.col("user_id").alias("unit_id"),
        F.col("_cycle").cast("int").alias("cycle"),
        F.lit(0.0).alias("op_setting_1"),
        F.col("value").alias("sensor_1"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_2"),
        (F.hour("ts") + F.minute("ts") / F.lit(60.0)).alias("sensor_3"),
        *extra,
    )
    return Fleet(pinned(df) if hot else df, hot)


def gaps(spark: SparkSession, sf_dir: str) -> Fleet:
    """The fleet with readings of sensor 1 missing on error events."""
    view = fleet(spark, sf_dir, ("event_type",))
    lost = F.when(F.col("event_type") != "error", F.col("sensor_1"))
    return view._replace(df=view.df.withColumn("sensor_1", lost).drop("event_type"))


def frozen(spark: SparkSession, sf_dir: str) -> Fleet:
    """The fleet with sensor 2 of every tenth unit stuck from cycle 20 on."""
    view = fleet(spark, sf_dir)
    stuck = (F.col("unit_id") % 10 == 0) & (F.col("cycle") >= 20)
    value = F.when(stuck, F.lit(7.0)).otherwise(F.col("sensor_2"))
    return view._replace(df=view.df.withColumn("sensor_2", value))


def labelled(view: Fleet) -> Fleet:
    return view._replace(df=add_binary_label(add_rul(view.df, view.hot)))


def scored(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> Fleet:
    """Labelled fleet with a risk in hundredths (many ties, values on bin edges) and a
    predicted remaining life."""
    view = labelled(fleet(spark, sf_dir, extra))
    risk = F.col("sensor_2") / F.lit(100.0)
    predicted = F.lit(90.0) - F.col("cycle") + (F.col("sensor_2") - 50.0) / F.lit(4.0)
    return view._replace(
        df=view.df.withColumns({"risk": risk, "predicted_rul": predicted}).drop(
            "op_setting_1", "sensor_1", "sensor_2", "sensor_3"
        )
    )


def wide(spark: SparkSession, sf_dir: str) -> Fleet:
    """`lineitem` as readings: a supplier is a unit, its lines by ship date are cycles, the
    supplier's region is the variant."""
    lines = table(spark, sf_dir, "lineitem")
    hot = oversized(lines, ["l_suppkey"])
    ordered = numbered(lines, ["l_suppkey"], WIDE_ORDER, "_cycle", hot=hot)
    homes = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "r_name")
    )
    df = ordered.join(homes, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("r_name").alias("variant"),
        F.col("l_suppkey").alias("unit_id"),
        F.col("_cycle").cast("int").alias("cycle"),
        F.col("l_quantity").alias("sensor_1"),
        F.col("l_extendedprice").alias("sensor_2"),
        F.col("l_discount").alias("sensor_3"),
        F.col("l_tax").alias("sensor_4"),
    )
    return Fleet(pinned(df) if hot else df, hot)


def doc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document labels with text length scaled to [0, 1] as the score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    top = docs.agg(F.max("n_chars").cast("double").alias("top"))
    joined = table(spark, sf_dir, "labels").join(docs, "doc_id")
    return joined.withColumn("risk", F.col("n_chars") / top.scalar()).select(
        "doc_id", "lang", "quality", "toxic", "risk"
    )
