"""One call from an input file or table to analysis and forecast results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridtide.functions.columns import infer_key_columns
from gridtide.operators.clean import clean_load_data
from gridtide.operators.forecast import ForecastResult, run_forecast
from gridtide.operators.models import ForecastConfig
from gridtide.operators.select import TimeRange, filter_by_time, resolve_time_range
from gridtide.plans.analysis import run_analysis, write_all
from gridtide.plans.forecast import component_tables, forecast_views
from gridtide.sources.csv import choose_primary_dataset, load_csv
from gridtide.sources.tables import run_metadata, write_clean_series, write_forecast, write_table


def load_clean(
    spark: SparkSession, path: str, folder: str, keys: Sequence[str] = (), **selection_options
) -> tuple[DataFrame, TimeRange]:
    """Read, clean, store and select; the clean table is written once and read by all later steps."""
    raw, encoding = load_csv(spark, path)
    roles = infer_key_columns(raw, tuple(keys))
    clean = clean_load_data(raw, roles.timestamp, roles.load, keys)
    stored = spark.read.parquet(write_clean_series(clean.frame, f"{folder}/clean", keys))
    write_table(clean.quality, f"{folder}/data_quality_report", "csv", bom=True)
    selection = resolve_time_range(stored, **(selection_options or {"mode": "all"}))
    chosen = filter_by_time(stored, selection)
    write_table(run_metadata(chosen, path, encoding, roles.timestamp, roles.load, selection), f"{folder}/dataset_metadata", "csv", bom=True)
    return chosen, selection


def run(
    spark: SparkSession, folder: str, *, path: str | None = None, root: str = ".", mode: str = "analysis",
    method: str = "best", config: ForecastConfig = ForecastConfig(), keys: Sequence[str] = (), time_range: dict | None = None,
) -> ForecastResult | None:
    """`mode` is analysis, forecast or both; `time_range` holds `resolve_time_range` arguments."""
    if mode not in ("analysis", "forecast", "both"):
        raise ValueError(f"Unknown mode: {mode}")
    path = path or choose_primary_dataset(spark, root)
    df, selection = load_clean(spark, path, folder, keys, **(time_range or {}))
    if mode in ("analysis", "both"):
        run_analysis(df, f"{folder}/analysis/{selection.label}", selection.description, keys)
    if mode == "analysis":
        return None
    result = run_forecast(df, config, method, keys)
    target = f"{folder}/forecast/{method.lower()}_{selection.label}"
    write_all({**component_tables(result.series), **forecast_views(result)}, target)
    write_forecast(result, target, keys)
    return result
