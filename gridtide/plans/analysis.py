"""The analysis run: every table, and the data behind every chart, of one selection of series."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame

from gridtide.operators import describe, distribution, relate
from gridtide.operators.position import index_series
from gridtide.operators.spectrum import spectrum
from gridtide.session import stored
from gridtide.sources.tables import analysis_scope, write_table


def analysis_tables(df: DataFrame, description: str, keys: Sequence[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """Name to table maker. `df` is a clean, filtered frame with calendar columns, best read from a table.

    Tables are made on demand, so a caller pays only for those it reads. Positions, differences and the
    autocorrelation are stored when first asked for and read by all tables that need them.
    """
    keys = list(keys)

    @cache
    def indexed() -> DataFrame:
        return stored(index_series(df, keys, totals=["load"]), "indexed")

    @cache
    def ramps() -> DataFrame:
        return stored(relate.differences(indexed(), keys).select(*keys, "timestamp", "ramp", "diff2"), "ramps")

    @cache
    def acf() -> DataFrame:
        return stored(relate.autocorrelation(df, keys), "acf")

    tables: dict[str, Callable[[], DataFrame]] = {
        "analysis_scope": lambda: analysis_scope(df, description),
        "filtered_load_data": lambda: df,
        "basic_statistics": lambda: describe.basic_statistics(df, keys),
        "monthly_volatility": lambda: describe.monthly_volatility(df, keys),
        "daily_peak_valley_metrics": lambda: describe.peak_valley_metrics(df, keys),
        "monthly_average_load": lambda: describe.month_profile(df, keys),
        "monthly_load_boxplot": lambda: describe.box_statistics(df, [*keys, "month"]),
        "monthly_load_outliers": lambda: describe.box_outliers(df, [*keys, "month"]),
        "weekday_vs_weekend_load": lambda: describe.weekpart_profile(df, keys),
        "seasonal_load": lambda: describe.season_profile(df, keys),
        "load_histogram": lambda: distribution.histogram(df, "load", distribution.LOAD_BINS, keys),
        "load_density": lambda: distribution.density(df, "load", distribution.LOAD_BINS, keys),
        "load_ecdf": lambda: distribution.empirical_cdf(df, "load", keys),
        "differences": ramps,
        "acf": acf,
        "pacf": lambda: relate.partial_autocorrelation(acf(), keys),
        "lag_pairs": lambda: relate.lag_pairs(indexed(), keys),
        "correlation_matrix": lambda: relate.load_correlations(df, keys),
        "spectrum": lambda: spectrum(indexed().select(*keys, "timestamp", "load", "idx", "n", "total_load"), keys, hours=relate.sampling_hours(df, keys)),
    }
    for scale in describe.SCALES:
        tables[f"{scale}_statistics"] = lambda scale=scale: describe.describe_scale(df, scale, keys)
    for column, name in (("ramp", "diff1"), ("diff2", "diff2")):
        tables[f"{name}_histogram"] = lambda c=column: distribution.histogram(ramps(), c, distribution.DIFFERENCE_BINS, keys)
        tables[f"{name}_density"] = lambda c=column: distribution.density(ramps(), c, distribution.DIFFERENCE_BINS, keys)
    if relate.match_weather_columns(df.columns, ("timestamp", "load", *keys)).keys() >= {"temperature", "humidity", "rainfall"}:
        tables["weather_correlation"] = lambda: relate.weather_correlation(df, keys)
    return tables


def run_analysis(df: DataFrame, folder: str, description: str, keys: Sequence[str] = (), fmt: str = "csv") -> dict[str, str]:
    """Write every analysis table below `folder`; name to path."""
    return write_all(analysis_tables(df, description, keys), folder, fmt)


def write_all(tables: dict[str, Callable[[], DataFrame]], folder: str, fmt: str = "csv") -> dict[str, str]:
    return {name: write_table(make(), f"{folder}/{name}", fmt) for name, make in tables.items()}
