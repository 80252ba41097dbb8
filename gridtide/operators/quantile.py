"""Ranks and exact quantiles by group, without ever gathering a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.operators.skew import lookup
from gridtide.session import materialise


def distinct_values(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """`keys…, value, count, _part`: distinct non-null values in order over the partitions, written once."""
    counts = (
        df.select(*keys, F.col(value).alias("value")).filter(F.col("value").isNotNull())
        .groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("count"))
    )
    return materialise(counts.repartitionByRange(*keys, "value").withColumn("_part", F.spark_partition_id()))


def ranked(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the values of `distinct_values` from the totals of the partitions."""
    totals = parts.groupBy(*keys, "_part").agg(F.sum("count").alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys, "_part",
        F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy(*keys)).alias("n"),
    )
    inside = Window.partitionBy("_at").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("count").over(inside), F.lit(0))
    placed = lookup(parts, starts, [*keys, "_part"], keep="_at")
    return placed.withColumn("below", below).drop("_at", "_part", "_before")


def value_ranks(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their `count`, the number of smaller values `below`, and the total `n`.

    Equal values collapse first. The rest is range-partitioned by value, written once so that the
    partition numbers are final, and numbered from the per-partition totals; a hot series spans many partitions.
    """
    return ranked(distinct_values(df, value, keys), keys)


def at_ranks(probabilities: Sequence[float], names: Sequence[str], value: str = "value") -> list[Column]:
    """Aggregates over `value_ranks` rows: quantiles interpolated between the two nearest ranks."""
    out = []
    for p, name in zip(probabilities, names):
        place = F.lit(float(p)) * (F.col("n") - 1)

        def on(rank: Column) -> Column:
            return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("count")), F.col(value)))

        low, high, share = on(F.floor(place)), on(F.ceil(place)), F.max(place - F.floor(place))
        out.append(F.when((share == 0) | (low == high), low).otherwise((1 - share) * low + share * high).alias(name))
    return out


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row per group with linear-interpolated quantiles of the non-null values.

    The order is that of doubles: -Infinity, numbers, Infinity, NaN. Three passes, whatever the values and sizes:
    distinct values are counted, put in order over the partitions, and numbered; the wanted ranks are picked from them.
    """
    return value_ranks(df, value, groups).groupBy(*groups).agg(*at_ranks(probabilities, names))
