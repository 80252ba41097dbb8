"""Sinks: result tables, run metadata and forecast artifacts."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.operators.forecast import ForecastResult
from gridtide.operators.score import METRICS, metrics_long
from gridtide.operators.select import TimeRange

BYTE_ORDER_MARK = "\ufeff"


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite", bom: bool = True
) -> str:
    """Write a table; unless `bom` is off, every CSV file starts with a UTF-8 byte-order mark for spreadsheet programs."""
    writer = df
    if fmt == "csv":
        # The CSV writer's own time format stops at milliseconds.
        times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]
        writer = df.withColumns({c: F.col(c).cast("string") for c in times})
    if fmt == "csv" and bom:
        first = next(c for c in df.columns if c not in partition_by)
        writer = writer.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    out = writer.write.mode(mode)
    if partition_by:
        out = out.partitionBy(*partition_by)
    if fmt == "csv":
        out = out.option("header", "true").option("encoding", "UTF-8")
    out.format(fmt).save(path)
    return path


def write_clean_series(df: DataFrame, path: str, keys: Sequence[str] = ()) -> str:
    """Clean series in folders by year and month, so that time ranges skip files, and in order of series inside.

    Rows are dealt out by ranges of month and series, so there are about as many files as tasks and months, however
    many series there are; a reader of one series skips files and row groups by their smallest and largest key.
    """
    order = ["year", "month", *keys, "timestamp"]
    return write_table(df.repartitionByRange(*order).sortWithinPartitions(*order), path, partition_by=["year", "month"])


def _text_rows(row: DataFrame, key: str) -> DataFrame:
    names = row.columns
    return row.select(*[F.col(n).cast("string") for n in names]).unpivot([], names, key, "value")


def run_metadata(df: DataFrame, path: str, encoding: str, timestamp_col: str, load_col: str, selection: TimeRange) -> DataFrame:
    """`field, value` of one run; `df` holds the selected rows."""
    row = df.agg(
        F.lit(path).alias("dataset_path"), F.lit(encoding).alias("encoding"), F.lit(timestamp_col).alias("timestamp_column"),
        F.lit(load_col).alias("load_column"), F.lit(selection.description).alias("selection"),
        F.count(F.lit(1)).alias("rows_after_filter"),
    )
    return _text_rows(row, "field")


def analysis_scope(df: DataFrame, description: str) -> DataFrame:
    """`field, value`: first and last time, row count and the selection."""
    row = df.agg(
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"),
        F.count(F.lit(1)).alias("rows"), F.lit(description).alias("selection"),
    )
    return _text_rows(row, "field")


def component_export(rows: DataFrame, names: Sequence[str], keys: Sequence[str] = (), rest: str | None = "residual") -> DataFrame:
    """`keys…, timestamp, IMF1…` and, when named, the remainder column."""
    parts = [F.col(c).alias(f"IMF{i}") for i, c in enumerate(names, start=1)]
    return rows.select(*keys, "timestamp", *parts, *([rest] if rest else []))


def _metric_lines(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    prefix = [F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.lit(" ")] if keys else []
    return metrics_long(table, keys).select(F.concat(*prefix, "metric", F.lit(": "), F.format_string("%.6f", F.col("value"))).alias("value"))


def write_forecast(result: ForecastResult, folder: str, keys: Sequence[str] = (), fmt: str = "csv") -> list[str]:
    """Forecast, metrics (table, text, JSON), component metrics, selection and best-method summary.

    The best of several methods brings the tables of every candidate along; series that were too short are listed.
    """
    name, keys = result.method, list(keys)
    columns = [*keys, "timestamp", "actual_load", "predicted_load", "error"]
    written = [
        write_table(result.forecast.select(*columns), f"{folder}/{name}_forecast", fmt),
        write_table(metrics_long(result.metrics, keys), f"{folder}/{name}_metrics", fmt),
        write_table(result.metrics, f"{folder}/{name}_metrics_json", "json"),
        write_table(_metric_lines(result.metrics, keys), f"{folder}/{name}_metrics_text", "text"),
    ]
    if result.component_metrics is not None:
        written.append(write_table(result.component_metrics, f"{folder}/{name}_component_metrics", fmt))
    if result.selection is not None:
        written.append(write_table(result.selection, f"{folder}/imf_model_selection", fmt))
    if result.best_method is not None:
        best = result.best_method.select(*keys, "best_method", *METRICS)
        written.append(write_table(best, f"{folder}/best_method_metrics", "json"))
        lead = F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.lit("best_method: ")) if keys else F.lit("best_method: ")
        line = best.select(F.concat(lead, "best_method").alias("value"))
        written.append(write_table(line.unionByName(_metric_lines(best, keys)), f"{folder}/best_method_summary", "text"))
    for candidate in result.candidates:
        written += write_forecast(dataclasses.replace(candidate, series=None), folder, keys, fmt)
    if result.series is not None and result.series.rejected is not None and keys:
        written.append(write_table(result.series.rejected, f"{folder}/rejected_series", fmt))
    return written
