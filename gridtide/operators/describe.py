"""Descriptive tables of the load at several time scales."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.calendar import SEASON_ORDER, year_week
from gridtide.operators.quantile import quantiles
from gridtide.operators.skew import attach, lookup

QUARTILES = (0.25, 0.5, 0.75)
DESCRIBE_NAMES = ("25%", "50%", "75%")
# The rows of the basic statistics table, in order.
BASIC_METRICS = (
    "count", "mean", "median", "min", "max", "std", "variance", "coefficient_of_variation",
    "skewness", "kurtosis", "q1", "q2", "q3",
)
SCALES = {
    "yearly": ("year",),
    "monthly": ("year", "month"),
    "weekly": ("year_week",),
    "daily": ("date",),
    "hourly": ("hour",),
}


def _with_quantiles(df: DataFrame, groups: Sequence[str], value: str, aggregates: list[Column], names: Sequence[str]) -> DataFrame:
    """Aggregates by group, joined to the quartiles."""
    return lookup(df.groupBy(*groups).agg(*aggregates), quantiles(df, groups, value, QUARTILES, names), list(groups), how="left")


def describe(df: DataFrame, groups: Sequence[str], value: str = "load") -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max by group."""
    aggregates = [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]
    out = _with_quantiles(df, groups, value, aggregates, DESCRIBE_NAMES)
    return out.select(*groups, "count", "mean", "std", "min", *DESCRIBE_NAMES, "max")


def describe_scale(df: DataFrame, scale: str, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    """`describe` by year, month, `%Y-%W` week, date or hour of day; `df` carries calendar columns."""
    if scale == "weekly":
        df = df.withColumn("year_week", year_week("timestamp"))
    return describe(df, [*keys, *SCALES[scale]], value)


def skewness_unbiased(value: str) -> Column:
    n = F.count(value)
    return F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0)) * F.skewness(value)


def kurtosis_unbiased(value: str) -> Column:
    n = F.count(value)
    scale = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0))
    return scale * ((n + 1) * F.kurtosis(value) + 6)


def basic_statistics(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    """Long table `keys…, metric, value` of the thirteen basic statistics."""
    aggregates = [
        F.count(value).cast("double").alias("count"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"),
        F.var_samp(value).alias("variance"),
        (F.stddev_samp(value) / F.nullif(F.avg(value), F.lit(0.0))).alias("coefficient_of_variation"),
        skewness_unbiased(value).alias("skewness"),
        kurtosis_unbiased(value).alias("kurtosis"),
    ]
    wide = _with_quantiles(df, keys, value, aggregates, ("q1", "q2", "q3")).withColumn("median", F.col("q2"))
    return wide.unpivot(list(keys), list(BASIC_METRICS), "metric", "value")


def peak_valley_metrics(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    """Daily peak, valley, mean, deviation, difference and ratio; also valid on a stream."""
    daily = df.groupBy(*keys, F.to_date("timestamp").alias("date")).agg(
        F.max(value).alias("peak_load"),
        F.min(value).alias("valley_load"),
        F.avg(value).alias("avg_load"),
        F.stddev_samp(value).alias("std_load"),
    )
    return daily.withColumns({
        "peak_valley_diff": F.col("peak_load") - F.col("valley_load"),
        "peak_valley_ratio": F.col("peak_load") / F.nullif("valley_load", F.lit(0.0)),
    })


def monthly_volatility(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    monthly = df.groupBy(*keys, F.year("timestamp").alias("year"), F.month("timestamp").alias("month")).agg(
        F.avg(value).alias("monthly_mean"),
        F.stddev_samp(value).alias("monthly_std"),
        F.var_samp(value).alias("monthly_var"),
    )
    return monthly.withColumn("monthly_cv", F.col("monthly_std") / F.nullif("monthly_mean", F.lit(0.0)))


def month_profile(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    """Mean by month of the year on a full 1..12 spine; absent months are NULL.

    The spine is part of the aggregate: every series reports twelve conditional means, so there is no join.
    """
    month = F.month("timestamp")
    means = [F.avg(F.when(month == m, F.col(value))).alias(str(m)) for m in range(1, 13)]
    wide = df.groupBy(*keys).agg(*means)
    long = wide.unpivot(list(keys), [str(m) for m in range(1, 13)], "month", "mean_load")
    return long.withColumn("month", F.col("month").cast("int"))


def weekpart_profile(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    groups = [(F.weekday("timestamp") >= 5).alias("is_weekend"), F.hour("timestamp").alias("hour")]
    return df.groupBy(*keys, *groups).agg(F.avg(value).alias("mean_load"))


def season_profile(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame:
    """Mean by season and hour, with the fixed season order; `df` carries calendar columns."""
    order = F.array_position(F.array(*[F.lit(s) for s in SEASON_ORDER]), F.col("season")).cast("int")
    return df.groupBy(*keys, "season", "hour").agg(F.avg(value).alias("mean_load")).withColumn("season_order", order)


def _fences(df: DataFrame, groups: Sequence[str], value: str, whisker: float) -> DataFrame:
    reach = whisker * (F.col("q3") - F.col("q1"))
    fences = quantiles(df, groups, value, QUARTILES, ("q1", "median", "q3"))
    return fences.withColumns({"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})


def box_statistics(
    df: DataFrame, groups: Sequence[str], value: str = "load", whisker: float = 1.5
) -> DataFrame:
    """Quartiles, whisker ends and outlier count by group."""
    marked = attach(df.select(*groups, value), _fences(df, groups, value, whisker), groups)
    inside = F.col(value).between(F.col("low_fence"), F.col("high_fence"))
    return marked.groupBy(*groups).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.least(F.min(F.when(inside, F.col(value))), F.max("q1")).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col(value))), F.max("q3")).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def box_outliers(
    df: DataFrame, groups: Sequence[str], value: str = "load", whisker: float = 1.5
) -> DataFrame:
    """The rows beyond the whiskers of their group."""
    fences = _fences(df, groups, value, whisker).select(*groups, "low_fence", "high_fence")
    return attach(df, fences, groups).filter(~F.col(value).between(F.col("low_fence"), F.col("high_fence"))).drop(
        "low_fence", "high_fence"
    )
