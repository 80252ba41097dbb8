"""Raw table to clean series: coercion, duplicate averaging, interpolation and quality counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.functions.calendar import add_time_features, micros
from gridtide.functions.columns import quoted, to_number, to_timestamp
from gridtide.operators.position import CELL_ROWS, nearest_cells, time_cells
from gridtide.operators.skew import lookup
from gridtide.session import materialise

QUALITY_METRICS = (
    "raw_rows", "invalid_timestamp_rows", "invalid_load_rows", "duplicated_timestamp_rows",
    "remaining_missing_load", "remaining_missing_features", "cleaned_rows",
)


@dataclass(frozen=True)
class CleanSeries:
    frame: DataFrame
    quality: DataFrame


def coerce_columns(raw: DataFrame, timestamp_col: str, load_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """`keys…, timestamp, load, features…`: every cell that does not parse becomes NULL."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    features = [c for c in raw.columns if c not in (timestamp_col, load_col, *keys)]
    return raw.select(
        *[quoted(k) for k in keys],
        to_timestamp(quoted(timestamp_col), types[timestamp_col]).alias("timestamp"),
        to_number(quoted(load_col), types[load_col]).alias("load"),
        *[to_number(quoted(c), types[c]).alias(c) for c in features],
    )


def drop_invalid_times(df: DataFrame) -> DataFrame:
    return df.filter(F.col("timestamp").isNotNull())


def value_columns(df: DataFrame, keys: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != "timestamp" and c not in keys]


def average_duplicates(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series and time; repeated times take the mean of each column's known values."""
    means = [F.avg(quoted(c)).alias(c) for c in value_columns(df, keys)]
    return df.groupBy(*keys, "timestamp").agg(*means)


def interpolate_in_time(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Fill gaps linearly in elapsed time; before the first and after the last known value, repeat it.

    Neighbours are found inside time cells; the nearest known value beyond a cell comes from the
    table of cells, so no task ever holds a whole series.
    """
    columns = list(columns) if columns is not None else value_columns(df, keys)

    def known(c: str) -> Column:
        return F.when(quoted(c).isNotNull(), F.struct(micros("timestamp").alias("u"), quoted(c).alias("v")))

    firsts = [F.min(known(c)).alias(f"_first{i}") for i, c in enumerate(columns)]
    lasts = [F.max(known(c)).alias(f"_last{i}") for i, c in enumerate(columns)]
    cells = time_cells(df, keys, "timestamp", [*firsts, *lasts], cell_rows)
    span = range(len(columns))
    cells = nearest_cells(cells, keys, {f"_last{i}": f"_prev{i}" for i in span}, later=False)
    cells = nearest_cells(cells, keys, {f"_first{i}": f"_next{i}" for i in span}, later=True)
    near = cells.table.select(*keys, "_bits", "_cell", *[f"_prev{i}" for i in span], *[f"_next{i}" for i in span])
    rows = lookup(cells.place(df, keys, "timestamp"), near, [*keys, "_bits", "_cell"], keep="_at")
    rows = rows.withColumns({f"_known{i}": known(c) for i, c in enumerate(columns)})
    upto = Window.partitionBy("_at").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("_at").orderBy(F.col("timestamp").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({f"_prev{i}": F.coalesce(F.max(f"_known{i}").over(upto), F.col(f"_prev{i}")) for i in span})
    rows = rows.withColumns({f"_next{i}": F.coalesce(F.min(f"_known{i}").over(onward), F.col(f"_next{i}")) for i in span})
    filled = {c: _between(quoted(c), F.col(f"_prev{i}"), F.col(f"_next{i}")) for i, c in enumerate(columns)}
    return rows.withColumns(filled).select(*[quoted(c) for c in df.columns])


def _between(value: Column, before: Column, after: Column) -> Column:
    slope = (after["v"] - before["v"]) / F.nullif(after["u"] - before["u"], F.lit(0))
    inside = before["v"] + slope * (micros("timestamp") - before["u"])
    return F.coalesce(value, inside, before["v"], after["v"])


def summarise_times(typed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series and time, the missing time included: column means, known cells and rows.

    Both the clean series and the quality counts follow from this table, so the raw cells are parsed once.
    """
    columns = value_columns(typed, keys)
    return typed.groupBy(*keys, "timestamp").agg(
        *[F.avg(quoted(c)).alias(c) for c in columns],
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(quoted(c)).alias(f"_has{i}") for i, c in enumerate(columns)],
    )


def _summary_columns(summary: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in value_columns(summary, keys) if not c.startswith(("_rows", "_has"))]


def quality_of(summary: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`metric, value` counts before and after duplicate averaging, from `summarise_times`.

    A gap survives interpolation only where a series has no known value in that column at all,
    so the remaining gaps follow from counts without running the interpolation.
    """
    columns = _summary_columns(summary, keys)
    timed = F.col("timestamp").isNotNull()
    known = F.col(f"_has{columns.index('load')}")
    series = summary.groupBy(*keys).agg(
        F.sum("_rows").alias("raw_rows"),
        F.sum(F.when(~timed, F.col("_rows")).otherwise(0)).alias("invalid_timestamp_rows"),
        F.sum(F.col("_rows") - known).alias("invalid_load_rows"),
        F.count("timestamp").alias("cleaned_rows"),
        *[F.sum(F.when(timed, F.col(f"_has{i}")).otherwise(0)).alias(f"_has{i}") for i in range(len(columns))],
    )
    duplicated = F.col("raw_rows") - F.col("invalid_timestamp_rows") - F.col("cleaned_rows")
    holes = {c: F.when(F.col(f"_has{i}") == 0, F.col("cleaned_rows")).otherwise(0) for i, c in enumerate(columns)}
    per_series = series.withColumns({
        "duplicated_timestamp_rows": duplicated,
        "remaining_missing_load": holes["load"],
        "remaining_missing_features": sum((holes[c] for c in columns if c != "load"), F.lit(0)),
    })
    row = per_series.agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in QUALITY_METRICS])
    return row.unpivot([], list(QUALITY_METRICS), "metric", "value")


def quality_report(typed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`quality_of` for a coerced table."""
    return quality_of(summarise_times(typed, keys), keys)


def clean_load_data(raw: DataFrame, timestamp_col: str, load_col: str, keys: Sequence[str] = ()) -> CleanSeries:
    """Clean one table of series; the frame ends with the calendar columns."""
    summary = materialise(summarise_times(coerce_columns(raw, timestamp_col, load_col, keys), keys))
    unique = drop_invalid_times(summary).select(*[quoted(k) for k in keys], "timestamp", *[quoted(c) for c in _summary_columns(summary, keys)])
    return CleanSeries(add_time_features(interpolate_in_time(unique, keys)), quality_of(summary, keys))
