"""Tables around a forecast: its components, its errors, and the comparison of all models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, functions as F

from gridtide.operators import describe, distribution, score
from gridtide.operators.decompose import component_energy, components_long, reconstruct_bands
from gridtide.operators.forecast import ComponentSeries, ForecastResult, comparison_long, best_of, last_week, run_model_comparison
from gridtide.operators.models import ForecastConfig
from gridtide.operators.relate import sampling_hours
from gridtide.operators.spectrum import classify_components, component_spectra
from gridtide.plans.analysis import write_all
from gridtide.session import stored
from gridtide.sources.tables import component_export, write_table

Tables = dict[str, Callable[[], DataFrame]]


def component_tables(series: ComponentSeries) -> Tables:
    """Component exports and the data behind their charts; the remainder is not a component here."""
    keys, rows = list(series.keys), series.rows
    names = [c for c in series.components if c.startswith("imf_")]
    rest = next(c for c in series.components if c not in names)

    @cache
    def long() -> DataFrame:
        return stored(components_long(rows, names, [*keys, "idx", "n"]), "components")

    @cache
    def hours() -> DataFrame:
        return stored(sampling_hours(rows, keys), "hours")

    return {
        "emd_components": lambda: component_export(rows, names, keys, rest),
        "emd_decomposition_results": lambda: component_export(rows, names, keys, None),
        "imf_spectrum": lambda: component_spectra(long(), keys, hours()),
        "imf_frequency_classes": lambda: classify_components(long(), keys, hours()),
        "imf_energy": lambda: component_energy(rows, names, keys),
        "imf_reconstruction": lambda: reconstruct_bands(rows, names).select(*keys, "timestamp", "load", "high", "mid", "low", "trend"),
    }


def forecast_views(result: ForecastResult) -> Tables:
    """The data behind the forecast charts: the last week, and the distribution of actual minus predicted."""
    keys = list(result.series.keys)
    return {
        "forecast_last_week": lambda: last_week(result.forecast),
        "prediction_error_histogram": lambda: distribution.histogram(result.forecast, "error", distribution.ERROR_BINS, keys),
        "prediction_error_density": lambda: distribution.density(result.forecast, "error", distribution.ERROR_BINS, keys),
    }


def error_tables(forecast: DataFrame, holidays: DataFrame | None = None, keys: Sequence[str] = ()) -> Tables:
    """Error statistics and chart data, with errors as predicted minus actual."""
    keys = list(keys)
    errors = score.for_error_analysis(forecast)
    return {
        "period_error_stats": lambda: score.period_error_stats(errors, keys),
        "holiday_error_stats": lambda: score.holiday_error_stats(errors, holidays, keys),
        "period_error_box": lambda: describe.box_statistics(score.period_rows(errors), [*keys, "period"], "error"),
        "holiday_error_box": lambda: describe.box_statistics(score.with_day_type(errors, holidays), [*keys, "day_type"], "error"),
        "error_histogram": lambda: distribution.histogram(errors, "error", distribution.ERROR_BINS, keys),
        "error_density": lambda: distribution.density(errors, "error", distribution.ERROR_BINS, keys),
        "error_qq": lambda: distribution.normal_qq(errors, "error", keys),
        "error_qq_fit": lambda: distribution.normal_qq_fit(distribution.normal_qq(errors, "error", keys), keys),
    }


def run_comparison(
    df: DataFrame, cfg: ForecastConfig, folder: str, holidays: DataFrame | None = None, keys: Sequence[str] = (),
    models: Sequence[str] | None = None, fmt: str = "csv",
) -> DataFrame:
    """Compare `EMD+<model>` strategies, write their tables and the error analysis of the best; returns its forecast."""
    keys = list(keys)
    table, comparison, final = run_model_comparison(df, cfg, keys, models)
    columns = [*keys, "timestamp", "actual_load", "predicted_load", "error"]
    metrics = score.metrics(final, keys)
    write_table(table.orderBy(*keys, "RMSE", "MAE", "MAPE"), f"{folder}/emd_model_metrics", fmt)
    write_table(comparison, f"{folder}/model_comparison", fmt)
    write_table(comparison_long(comparison, keys), f"{folder}/model_comparison_long", fmt)
    write_table(best_of(comparison, keys), f"{folder}/best_model", fmt)
    write_table(final.select(*keys, F.col("strategy").alias("best_strategy")).distinct(), f"{folder}/best_forecast_strategy", fmt)
    write_table(final.select(*columns), f"{folder}/forecast_results", fmt)
    write_table(score.metrics_long(metrics, keys), f"{folder}/forecast_metrics", fmt)
    write_table(metrics, f"{folder}/forecast_metrics_json", "json")
    write_all(error_tables(final, holidays, keys), folder, fmt)
    return final
