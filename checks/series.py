"""The driver tables as load series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridtide.operators.clean import interpolate_in_time
from gridtide.session import materialise

KEYS = ["event_type"]
PRIORITY = ["o_orderpriority"]

# Stand-in public holidays that fall into the event month.
HOLIDAYS = ("2024-01-01", "2024-01-06", "2024-01-13", "2024-01-26", "2024-01-28", "2024-01-29")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Five irregular series, one row per event."""
    return table(spark, folder, "events").select("event_type", F.col("ts").alias("timestamp"), F.col("value").alias("load"))


def hour_sums(spark: SparkSession, folder: str) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp")
    return table(spark, folder, "events").groupBy("event_type", hour).agg(F.sum("value").alias("load"))


def hourly_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly sums on a full spine of hours; hours without events are NULL."""
    sums = hour_sums(spark, folder)
    hours = F.sequence(F.min("timestamp"), F.max("timestamp"), F.expr("INTERVAL 1 HOUR"))
    spine = sums.groupBy("event_type").agg(hours.alias("_h")).select("event_type", F.explode("_h").alias("timestamp"))
    return spine.join(sums, ["event_type", "timestamp"], "left")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Clean hourly series, stored before use like any cleaned input."""
    return materialise(interpolate_in_time(hourly_gaps(spark, folder), KEYS))


def priced_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Order values in thousands at their order date; many rows share a date."""
    return table(spark, folder, "orders").select(
        "o_orderpriority", F.col("o_orderdate").alias("timestamp"), (F.col("o_totalprice") / 1000).alias("load")
    )


def daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    return priced_orders(spark, folder).groupBy("o_orderpriority", "timestamp").agg(F.sum("load").alias("load"))


def weather_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Two event types as series, with the three others standing in for the weather columns of both."""
    roles = {"view": "temperature", "signup": "humidity", "purchase": "rainfall"}
    wide = hour_sums(spark, folder).groupBy("timestamp").pivot("event_type", ["click", "error", *roles]).agg(F.first("load"))
    return wide.withColumnsRenamed(roles).unpivot(["timestamp", *roles.values()], ["click", "error"], "event_type", "load")


def dirty_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as text cells with bad times, bad numbers, gaps and repeated minutes put in."""
    n = F.col("event_id")
    time = F.when(n % 29 == 0, "not-a-date").otherwise(F.date_format("ts", "yyyy/M/d H:mm"))
    load = F.when(n % 17 == 0, "x").when(n % 23 != 0, F.col("value").cast("string"))
    extra = F.when(n % 13 == 0, "abc").when(n % 7 != 0, F.col("user_id").cast("string"))
    return table(spark, folder, "events").select("event_type", time.alias("时间"), load.alias("负荷"), extra.alias("extra"))


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d,) for d in HOLIDAYS], "date string")
