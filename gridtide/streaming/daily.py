"""Daily load metrics kept up to date from a stream of measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def daily_peak_valley(stream: DataFrame, keys: Sequence[str] = (), lateness: str = "1 day", value: str = "load") -> DataFrame:
    """The daily peak/valley table in append mode: a day is final once the watermark has passed it.

    The state is one row of partial aggregates per series and open day. Watermarks need zoned
    timestamps, so wall-clock times are read in the session time zone, which must be UTC.
    """
    timed = stream.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    days = timed.withWatermark("timestamp", lateness).groupBy(*keys, F.window("timestamp", "1 day").alias("_day")).agg(
        F.max(value).alias("peak_load"),
        F.min(value).alias("valley_load"),
        F.avg(value).alias("avg_load"),
        F.stddev_samp(value).alias("std_load"),
    )
    return days.select(
        *keys, F.to_date("_day.start").alias("date"), "peak_load", "valley_load", "avg_load", "std_load",
        (F.col("peak_load") - F.col("valley_load")).alias("peak_valley_diff"),
        (F.col("peak_load") / F.nullif("valley_load", F.lit(0.0))).alias("peak_valley_ratio"),
    )
