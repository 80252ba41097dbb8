"""Forecast accuracy: metrics, segment statistics and the error views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.operators.select import flag_holidays, is_peak_hour, is_valley_hour

METRICS = ("MAE", "RMSE", "MAPE", "R2")
# Fixed value: true values closer to zero than this do not enter the percentage error.
NEAR_ZERO = 1e-8


def metric_columns(actual: str = "actual_load", predicted: str = "predicted_load") -> dict[str, Column]:
    error = F.col(actual) - F.col(predicted)
    squares = F.sum(error * error)
    # regr_syy needs both arguments known, so the spread covers exactly the scored rows.
    spread = F.regr_syy(actual, predicted)
    return {
        "MAE": F.avg(F.abs(error)),
        "RMSE": F.sqrt(F.avg(error * error)),
        "MAPE": 100 * F.avg(F.when(F.abs(F.col(actual)) >= NEAR_ZERO, F.abs(error / F.nullif(F.col(actual), F.lit(0.0))))),
        "R2": F.when(spread > 0, 1 - squares / F.nullif(spread, F.lit(0.0))),
    }


def metrics(
    df: DataFrame, groups: Sequence[str] = (), actual: str = "actual_load", predicted: str = "predicted_load",
    names: Sequence[str] = METRICS, count: str | None = None,
) -> DataFrame:
    """One row per group with the wanted metrics, and the row count when named."""
    columns = metric_columns(actual, predicted)
    aggregates = [columns[n].alias(n) for n in names]
    if count:
        aggregates.append(F.count(F.lit(1)).alias(count))
    return df.groupBy(*groups).agg(*aggregates)


def metrics_long(wide: DataFrame, groups: Sequence[str] = (), names: Sequence[str] = METRICS) -> DataFrame:
    return wide.select(*groups, *[F.col(n).cast("double") for n in names]).unpivot(list(groups), list(names), "metric", "value")


def for_error_analysis(forecast: DataFrame) -> DataFrame:
    """Error as predicted minus actual, the opposite sign of the forecast table."""
    return forecast.withColumn("error", F.col("predicted_load") - F.col("actual_load"))


def period_rows(forecast: DataFrame) -> DataFrame:
    """Rows of the peak and valley hours, labelled."""
    period = F.when(is_peak_hour(), "Peak Period").when(is_valley_hour(), "Valley Period")
    return forecast.withColumn("period", period).filter(F.col("period").isNotNull())


def period_error_stats(forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`keys…, period, MAE, RMSE, MAPE, sample_count` for peak and valley hours."""
    return metrics(period_rows(forecast), [*keys, "period"], names=METRICS[:3], count="sample_count")


def with_day_type(forecast: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    flagged = flag_holidays(forecast, holidays)
    return flagged.withColumn("day_type", F.when(F.col("is_holiday"), "Holiday").otherwise("Non-Holiday")).drop("is_holiday")


def holiday_error_stats(forecast: DataFrame, holidays: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """`keys…, category, MAE, RMSE, MAPE, sample_count` for holidays and other days."""
    typed = with_day_type(forecast, holidays).withColumnRenamed("day_type", "category")
    return metrics(typed, [*keys, "category"], names=METRICS[:3], count="sample_count")
