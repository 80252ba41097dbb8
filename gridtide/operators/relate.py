"""How a series relates to its own past and to other columns."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gridtide.functions.calendar import micros
from gridtide.functions.columns import match_weather_columns, quoted
from gridtide.operators.position import (
    BLOCK_ROWS, CELL_ROWS, Cells, block_window, home_rows, index_series, nearest_cells, time_cells, with_halo,
)
from gridtide.operators.quantile import quantiles
from gridtide.operators.skew import lookup

# Row lags of the lag views, and the most lags of the autocorrelation.
LAGS = (1, 24, 168)
MAX_LAGS = 100
BAND = NormalDist().inv_cdf(0.975)


def with_lags(
    indexed: DataFrame, keys: Sequence[str], lags: dict[str, int], value: str = "load", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the value a number of rows earlier; lags count rows, not time."""
    order = block_window(keys)
    shifted = {name: F.lag(value, rows).over(order) for name, rows in lags.items()}
    return home_rows(with_halo(indexed, max(lags.values()), 0, block_rows).withColumns(shifted), block_rows)


def differences(indexed: DataFrame, keys: Sequence[str] = (), value: str = "load", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the first (`ramp`) and second (`diff2`) differences."""
    lagged = with_lags(indexed, keys, {"_lag1": 1, "_lag2": 2}, value, block_rows)
    ramp = F.col(value) - F.col("_lag1")
    return lagged.withColumns({"ramp": ramp, "diff2": ramp - (F.col("_lag1") - F.col("_lag2"))}).drop("_lag1", "_lag2")


def lag_pairs(
    indexed: DataFrame, keys: Sequence[str] = (), lags: Sequence[int] = LAGS, value: str = "load", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`keys…, idx, lag, lagged, current` for every row that has the lagged value."""
    lagged = with_lags(indexed, keys, {f"lag_{k}": k for k in lags}, value, block_rows)
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"lag_{k}").alias("lagged")) for k in lags]))
    rows = lagged.select(*keys, "idx", F.col(value).alias("current"), pairs.alias("_p"))
    return rows.select(*keys, "idx", "_p.lag", "_p.lagged", "current").filter("lagged IS NOT NULL AND current IS NOT NULL")


def correlation_matrix(df: DataFrame, columns: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Long Pearson matrix over complete rows, from one aggregate of plain sums.

    Sums of products lose digits when means are large against deviations, so columns should come
    roughly centred; a shift does not change a correlation.
    """
    names = list(columns)
    size = range(len(names))
    complete = df.select(*keys, *[c.cast("double").alias(f"_c{i}") for i, c in enumerate(columns.values())]).dropna(
        subset=[f"_c{i}" for i in size]
    )
    sums = complete.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_c{i}").alias(f"_s{i}") for i in size],
        *[F.sum(F.col(f"_c{i}") * F.col(f"_c{j}")).alias(f"_p{i}_{j}") for i in size for j in size if i <= j],
    )

    def moment(i: int, j: int) -> Column:
        return F.col(f"_p{min(i, j)}_{max(i, j)}") - F.col(f"_s{i}") * F.col(f"_s{j}") / F.col("_n")

    def pearson(i: int, j: int) -> Column:
        spread = F.sqrt(F.greatest(moment(i, i) * moment(j, j), F.lit(0.0)))
        return moment(i, j) / F.nullif(spread, F.lit(0.0))

    # Only the upper triangle is computed; positions of one flat array name the cell of each value.
    triangle = [(i, j) for i in size for j in size if i <= j]
    wide = sums.select(*keys, *[pearson(i, j).alias(f"_r{i}_{j}") for i, j in triangle])
    flat = F.array(*[F.col(f"_r{min(i, j)}_{max(i, j)}") for i in size for j in size])
    labels = F.array(*[F.lit(name) for name in names])
    long = wide.select(*keys, F.posexplode(flat).alias("_pos", "corr"))
    return long.select(
        *keys,
        labels[F.floor(F.col("_pos") / len(names)).cast("int")].alias("feature"),
        labels[F.col("_pos") % len(names)].alias("other"),
        "corr",
    )


def load_correlations(
    df: DataFrame, keys: Sequence[str] = (), value: str = "load", block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Correlations of the load, its lags, the hour and the weekday."""
    indexed = index_series(df.select(*keys, "timestamp", value), keys, "timestamp", [value], cell_rows)
    centred = indexed.withColumn(value, F.col(value) - F.col(f"total_{value}") / F.col("n"))
    lagged = with_lags(centred, keys, {f"_lag{k}": k for k in LAGS}, value, block_rows)
    columns = {"load(t)": F.col(value), **{f"load(t-{k})": F.col(f"_lag{k}") for k in LAGS}}
    columns |= {"hour": F.hour("timestamp") - 11.5, "weekday": F.weekday("timestamp") - 3}
    return correlation_matrix(lagged, columns, keys)


def weather_correlation(df: DataFrame, keys: Sequence[str] = (), value: str = "load") -> DataFrame | None:
    """Pearson correlation of the load with temperature, humidity and rainfall on complete rows.

    None unless all three weather columns are found by name.
    """
    found = match_weather_columns(df.columns, ("timestamp", value, *keys))
    if len(found) < 3:
        return None
    complete = df.select(*keys, F.col(value).alias("_load"), *[quoted(c).cast("double").alias(r) for r, c in found.items()])
    complete = complete.dropna(subset=["_load", *found])
    wide = complete.groupBy(*keys).agg(*[F.corr("_load", role).alias(role) for role in found])
    return wide.unpivot(list(keys), list(found), "feature", "corr")


def time_steps(df: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp", cell_rows: int = CELL_ROWS) -> DataFrame:
    """`keys…, seconds` between successive rows; NULL on the first row of a series."""
    return _time_steps(df, keys, ts, _last_times(df, keys, ts, cell_rows))


def _last_times(df: DataFrame, keys: Sequence[str], ts: str, cell_rows: int) -> Cells:
    return time_cells(df, keys, ts, [F.max(micros(ts)).alias("_last")], cell_rows)


def _time_steps(df: DataFrame, keys: Sequence[str], ts: str, cells: Cells) -> DataFrame:
    near = nearest_cells(cells, keys, {"_last": "_prev"}, later=False).table.select(*keys, "_bits", "_cell", "_prev")
    rows = cells.place(df.select(*keys, ts), keys, ts).select(*keys, micros(ts).alias("_u"), "_bits", "_cell")
    earlier = F.coalesce(F.lag("_u").over(Window.partitionBy("_at").orderBy("_u")), F.col("_prev"))
    return lookup(rows, near, [*keys, "_bits", "_cell"], keep="_at").select(*keys, ((F.col("_u") - earlier) / 1e6).alias("seconds"))


def sampling_hours(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Median time step in hours by series; 1.0 where there is none or it is not positive."""
    cells = _last_times(df, keys, ts, cell_rows)
    steps = _time_steps(df, keys, ts, cells)
    series = cells.table.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))
    return _median_hours(series, steps, keys)


def hours_of_steps(rows: DataFrame, keys: Sequence[str] = (), seconds: str = "seconds") -> DataFrame:
    """The same from rows that carry the seconds since the row before, as `index_series` gives them."""
    return _median_hours(rows.filter("idx = 0").select(*keys), rows.select(*keys, F.col(seconds).alias("seconds")), keys)


def _median_hours(series: DataFrame, steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    middle = quantiles(steps, keys, "seconds", [0.5], ["_step"])
    hours = F.when(F.col("_step") > 0, F.col("_step") / 3600.0).otherwise(1.0)
    return lookup(series, middle, list(keys), how="left").select(*keys, hours.alias("sampling_hours"))


def autocorrelation(
    df: DataFrame, keys: Sequence[str] = (), value: str = "load", max_lags: int = MAX_LAGS,
    block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """`keys…, lag, acf, band` for lags 1..min(max_lags, n // 2 - 1), at least one lag.

    The series mean rides along with the positions. Each block of bounded size, with the rows before it
    that the lags reach, yields one partial sum per lag; those are added up by series.
    """
    known = df.filter(F.col(value).isNotNull()).select(*keys, "timestamp", value)
    rows = index_series(known, keys, "timestamp", [value], cell_rows)
    rows = rows.select(*keys, "idx", "n", (F.col(value) - F.col(f"total_{value}") / F.col("n")).alias("_d"))
    spread = with_halo(rows, max_lags, 0, block_rows)
    keys = list(keys)

    def products(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx")
        d = block["_d"].to_numpy()
        first = int((block["idx"] // block_rows < block["_block"]).sum())
        own = d[first:]
        out = {k: np.repeat(block[k].iloc[:1].to_numpy(), max_lags + 1) for k in keys}
        out["n"] = np.full(max_lags + 1, block["n"].iloc[0])
        out["lag"] = np.arange(max_lags + 1)
        # Row first + i meets row first + i - lag; rows before the series start have no partner.
        out["_ck"] = [own[max(lag - first, 0):] @ d[max(first - lag, 0): max(len(d) - lag, 0)] for lag in range(max_lags + 1)]
        return pd.DataFrame(out)

    schema = T.StructType([
        *[spread.schema[k] for k in keys],
        T.StructField("n", T.LongType()), T.StructField("lag", T.IntegerType()), T.StructField("_ck", T.DoubleType()),
    ])
    sums = spread.groupBy(*keys, "_block").applyInPandas(products, schema)
    sums = sums.groupBy(*keys, "n", "lag").agg(F.sum("_ck").alias("_ck"))
    series = Window.partitionBy(*keys)
    long = sums.withColumn("_c0", F.max(F.when(F.col("lag") == 0, F.col("_ck"))).over(series))
    lags = F.greatest(F.lit(1), F.least(F.lit(max_lags), F.floor(F.col("n") / 2) - 1))
    long = long.filter(F.col("lag").between(F.lit(1), lags))
    long = long.withColumn("acf", F.col("_ck") / F.nullif("_c0", F.lit(0.0)))
    earlier = Window.partitionBy(*keys).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.col("acf") * F.col("acf")).over(earlier), F.lit(0.0))
    return long.select(*keys, "lag", "acf", (BAND * F.sqrt((1 + 2 * squares) / F.col("n"))).alias("band"), "n")


def partial_autocorrelation(acf: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`keys…, lag, pacf, band` by the Levinson-Durbin recursion over an `autocorrelation` table.

    The recursion runs on one array of at most 100 values per series.
    """
    series = acf.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda e: e["acf"]).alias("_r"), F.max("n").alias("n")
    )
    empty = F.array().cast("array<double>")
    start = F.struct(empty.alias("phi"), F.lit(1.0).alias("v"), empty.alias("out"))

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(state: Column, k: Column) -> Column:
        known = F.slice("_r", F.lit(1), k - 1)
        reflection = (F.element_at("_r", k) - dot(state["phi"], F.reverse(known))) / F.nullif(state["v"], F.lit(0.0))

        def extend(p: Column) -> Column:
            phi = F.zip_with(state["phi"], F.reverse(state["phi"]), lambda a, b: a - p * b)
            return F.struct(
                F.concat(phi, F.array(p)).alias("phi"),
                (state["v"] * (1 - p * p)).alias("v"),
                F.concat(state["out"], F.array(p)).alias("out"),
            )

        return F.transform(F.array(reflection), extend)[0]

    values = F.aggregate(F.sequence(F.lit(1), F.size("_r")), start, step, lambda s: s["out"])
    long = series.select(*keys, "n", F.posexplode(values).alias("_pos", "pacf"))
    return long.select(*keys, (F.col("_pos") + 1).alias("lag"), "pacf", (BAND / F.sqrt("n")).alias("band"))
