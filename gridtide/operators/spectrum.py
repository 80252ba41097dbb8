"""Amplitude spectrum of a series and the frequency class of components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridtide.operators.position import index_series
from gridtide.operators.relate import hours_of_steps
from gridtide.operators.skew import attach, lookup
from gridtide.session import stored

# A series of up to this many rows is transformed in one task (16 MB of complex values).
GROUP_POINTS = 1 << 20
# Columns or rows of a long transform that one task makes at a time.
TILE = 64
# Lower bounds of the high and mid classes, in cycles per hour.
HIGH_FREQUENCY = 0.1
MID_FREQUENCY = 0.02


def spectrum(
    df: DataFrame, keys: Sequence[str] = (), value: str = "load", hours: DataFrame | float | None = 1.0,
    group_points: int = GROUP_POINTS,
) -> DataFrame:
    """`keys…, harmonic, frequency, amplitude` for the positive frequencies of the mean-centred series.

    `hours` is the sampling step: one number, or a table `keys…, sampling_hours`; with None it is the median step of each series, found while the rows
    are numbered. Short series are transformed in one task each; series beyond `group_points` go through `_long_amplitudes`.
    """
    if hours is None:
        df = stored(index_series(df.select(*keys, "timestamp", value), keys, totals=[value], step="_seconds"), "numbered")
        hours = hours_of_steps(df, keys, "_seconds")
    ready = "idx" in df.columns and f"total_{value}" in df.columns
    rows = df if ready else index_series(df, keys, totals=[value])
    largest = (df if ready else df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))).agg(F.max("n")).first()[0] or 0
    centred = rows.select(*keys, "idx", "n", (F.col(value) - F.col(f"total_{value}") / F.col("n")).alias("x"))
    short = centred.filter(F.col("n") <= group_points)
    amplitudes = _short_amplitudes(short, keys)
    if largest > group_points:
        amplitudes = amplitudes.unionByName(_long_amplitudes(centred.filter(F.col("n") > group_points), keys))
    if isinstance(hours, DataFrame):
        step_keys = [k for k in keys if k in hours.columns]
        amplitudes = attach(amplitudes, hours, step_keys)
    else:
        amplitudes = amplitudes.withColumn("sampling_hours", F.lit(float(hours)))
    frequency = F.col("harmonic") / (F.col("n") * F.col("sampling_hours"))
    return amplitudes.select(*keys, "harmonic", frequency.alias("frequency"), "amplitude")


def _schema(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def _short_amplitudes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)

    def transform(group: pd.DataFrame) -> pd.DataFrame:
        n = len(group)
        signal = np.empty(n)
        signal[group["idx"].to_numpy()] = group["x"].to_numpy()
        top = (n - 1) // 2
        out = {k: np.repeat(group[k].iloc[:1].to_numpy(), top) for k in keys}
        out["n"] = np.full(top, n)
        out["harmonic"] = np.arange(1, top + 1)
        out["amplitude"] = np.abs(np.fft.rfft(signal)[1 : top + 1])
        return pd.DataFrame(out)

    schema = T.StructType([
        *_schema(rows, keys),
        T.StructField("n", T.LongType()), T.StructField("harmonic", T.LongType()), T.StructField("amplitude", T.DoubleType()),
    ])
    # A constant second key keeps the grouped form valid when there are no series keys.
    return rows.withColumn("_one", F.lit(1)).groupBy(*keys, "_one").applyInPandas(transform, schema)


def _sizes(n: int) -> tuple[int, int]:
    """`n1, n2`: powers of two, near each other, whose product is at least 2n - 1."""
    bits = max((2 * n - 2).bit_length(), 0)
    return 1 << (bits + 1) // 2, 1 << bits // 2


def _chirp(j: np.ndarray, n: int) -> np.ndarray:
    """exp(i*pi*j^2/n), with j^2 reduced modulo 2n in whole numbers before it becomes an angle."""
    j = j.astype(np.uint64) if n < 1 << 31 else j.astype(object)
    return np.exp(1j * np.pi * ((j * j) % (2 * n)).astype(float) / n)


def _turn(a: np.ndarray, b: np.ndarray, m: int) -> np.ndarray:
    """exp(-2*pi*i*a*b/m) of all pairs; a*b is below m."""
    return np.exp(-2j * np.pi * np.outer(a, b) / m)


def _tiles(values: np.ndarray, row0: int, keys: pa.Table, n: int) -> pa.Table:
    """A matrix, whose rows begin at `row0`, cut along its columns into tiles of bytes, for tasks that want whole columns."""
    starts = range(0, values.shape[-1], TILE)
    cut = [np.ascontiguousarray(values[..., c : c + TILE]).tobytes() for c in starts]
    keys = keys.take(pa.array([0] * len(cut), pa.int64()))
    return pa.table([*keys.columns, pa.array([n] * len(cut), pa.int64()), pa.array(list(starts), pa.int64()), pa.array([row0] * len(cut), pa.int64()), pa.array(cut, pa.binary())], names=[*keys.column_names, "n", "group", "part", "tile"])


def _long_amplitudes(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amplitudes for any length, as a chirp convolution over a power-of-two length m = n1 * n2 >= 2n - 1.

    a_j = x_j * exp(-i*pi*j^2/n), b_j = exp(i*pi*j^2/n) mirrored round m; |X_k| is the modulus of their circular convolution.
    A transform of length m is made in two halves, with j = j1 * n2 + j2 and k = k1 + n1 * k2: columns of equal j2, a rotation, then rows of
    equal k1. The way back begins with the rows that a task has just made, so there are three shuffles: of the values, and twice of tiles.
    No task holds more than about `TILE` times the square root of m values.
    """
    keys = list(keys)
    tiles = T.StructType([*_schema(rows, keys), *[T.StructField(c, T.LongType()) for c in ("n", "group", "part")], T.StructField("tile", T.BinaryType())])
    found = T.StructType([*_schema(rows, keys), T.StructField("n", T.LongType()), T.StructField("harmonic", T.LongType()), T.StructField("amplitude", T.DoubleType())])

    def head(table: pa.Table) -> tuple[pa.Table, int, int, int, int]:
        n = table["n"][0].as_py()
        n1, n2 = _sizes(n)
        return table.select(keys).slice(0, 1), n, n1, n2, table["group"][0].as_py()

    def gathered(table: pa.Table, matrices: int, width: int) -> np.ndarray:
        """The tiles of whole columns below each other."""
        tiles = table.sort_by("part")["tile"]
        return np.concatenate([np.frombuffer(t.as_buffer(), complex).reshape(matrices, -1, width) for t in tiles], axis=1)

    def columns(table: pa.Table) -> pa.Table:
        """For some j2: values and chirp at all j1, transformed to k1."""
        first, n, n1, n2, j2 = head(table)
        wide = min(TILE, n2)
        x = np.zeros((n1, wide))
        idx = table["idx"].to_numpy()
        x[idx // n2, idx % n2 - j2] = table["x"].fill_null(np.nan).to_numpy()
        m, j = n1 * n2, np.arange(n1)[:, None] * n2 + np.arange(j2, j2 + wide)
        near = np.minimum(j, m - j)
        chirp = np.where(near < n, _chirp(np.where(near < n, near, 0), n), 0)
        a = np.where(j < n, x * chirp.conj(), 0)
        both = np.fft.fft(np.stack([a, chirp]), axis=1) * _turn(np.arange(n1), np.arange(j2, j2 + wide), m)
        return _tiles(both.transpose(0, 2, 1), j2, first, n)

    def rows_of(table: pa.Table) -> pa.Table:
        """For some k1: the transform over all j2, the product, and the first half of the way back, over k2."""
        first, n, n1, n2, k1 = head(table)
        a, b = np.fft.fft(gathered(table, 2, min(TILE, n1)), axis=1)  # k2 by k1
        # The inverse transform's modulus is that of the forward transform of the conjugate, over m.
        back = np.fft.fft((a * b).conj(), axis=0) * _turn(np.arange(n2), np.arange(k1, k1 + a.shape[1]), n1 * n2)
        return _tiles(back.T, k1, first, n)

    def amplitudes(table: pa.Table) -> pa.Table:
        """For some remainders of the result's place by n2: the second half of the way back, over k1."""
        first, n, n1, n2, r = head(table)
        values = np.abs(np.fft.fft(gathered(table, 1, min(TILE, n2))[0], axis=0)) / (n1 * n2)
        place = np.arange(n1)[:, None] * n2 + np.arange(r, r + values.shape[1])
        here = (place >= 1) & (place <= (n - 1) // 2)
        count = int(here.sum())
        one = first.take(pa.array(np.zeros(count, np.int64)))
        return pa.table([*one.columns, pa.array(np.full(count, n)), pa.array(place[here]), pa.array(values[here])], names=found.names)

    n2 = F.pow(F.lit(2), F.floor(F.length(F.bin(2 * F.col("n") - 2)) / 2)).cast("long")
    grouped = [*keys, "group"]
    values = rows.withColumn("group", F.col("idx") % n2 - F.col("idx") % n2 % TILE)
    there = values.groupBy(*grouped).applyInArrow(columns, tiles)
    turned = there.groupBy(*grouped).applyInArrow(rows_of, tiles)
    return turned.groupBy(*grouped).applyInArrow(amplitudes, found)


def dominant_frequency(amplitudes: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Frequency of the largest amplitude by group; the lowest wins a tie."""
    return amplitudes.groupBy(*groups).agg(
        F.min_by("frequency", F.struct(-F.col("amplitude"), F.col("frequency"))).alias("dominant_freq")
    )


def frequency_class(frequency: Column | str) -> Column:
    frequency = F.col(frequency) if isinstance(frequency, str) else frequency
    return F.when(frequency > HIGH_FREQUENCY, "high").when(frequency > MID_FREQUENCY, "mid").otherwise("low")


def component_totals(long: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return long.groupBy(*keys, "component").agg(
        F.sum("value").alias("total_value"), F.sum(F.col("value") * F.col("value")).alias("energy")
    )


def component_spectra(
    long: DataFrame, keys: Sequence[str] = (), hours: DataFrame | float = 1.0, group_points: int = GROUP_POINTS
) -> DataFrame:
    """`spectrum` of every component; `long` has `keys…, idx, n, component, value`."""
    groups = [*keys, "component"]
    centred = attach(long, component_totals(long, keys).select(*groups, "total_value"), groups)
    return spectrum(centred, groups, "value", hours, group_points)


def classify_components(
    long: DataFrame, keys: Sequence[str] = (), hours: DataFrame | float = 1.0, group_points: int = GROUP_POINTS
) -> DataFrame:
    """`keys…, index, component, dominant_freq, energy, category` from long components with positions.

    A component without positive frequencies gets frequency 0.
    """
    groups = [*keys, "component"]
    peaks = dominant_frequency(component_spectra(long, keys, hours, group_points), groups)
    named = lookup(component_totals(long, keys).select(*groups, "energy"), peaks, groups, "left")
    frequency = F.coalesce("dominant_freq", F.lit(0.0))
    return named.select(
        *keys, F.regexp_extract("component", r"(\d+)$", 1).cast("int").alias("index"), "component",
        frequency.alias("dominant_freq"), "energy", frequency_class(frequency).alias("category"),
    )
