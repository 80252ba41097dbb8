"""Value distributions: histogram, kernel density, empirical CDF and normal Q-Q points."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridtide.operators.quantile import distinct_values, ranked
from gridtide.operators.skew import attach, lookup
from gridtide.session import materialise

# Bins per charted quantity, and the points of a density curve.
LOAD_BINS = 50
DIFFERENCE_BINS = 60
ERROR_BINS = 50
GRID_POINTS = 200
# Series whose kernel sums a task keeps before it passes them on.
OPEN_SERIES = 4096
# Samples of one value that a single task turns into rows.
RUN_ROWS = 1 << 16


def _span(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"), F.stddev_samp(value).alias("sd")
    )


def histogram(df: DataFrame, value: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """`keys…, bin, left, right, count` with equal widths; the last bin includes its right edge."""
    data = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    span = materialise(_span(data, keys, "_v")).select(
        *keys,
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins

    def left(i):
        return F.col("lo") + i * width

    def right(i):
        return F.when(i == bins - 1, F.col("hi")).otherwise(F.col("lo") + (i + 1) * width)

    guess = F.least(F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    placed = attach(data, span, keys).withColumn("_g", guess)
    # Division and edges round differently, so a value next to an edge may need one step either way.
    step = F.when(F.col("_v") < left(F.col("_g")), -1).when(
        (F.col("_g") < bins - 1) & (F.col("_v") >= right(F.col("_g"))), 1
    ).otherwise(0)
    counts = placed.groupBy(*keys, (F.col("_g") + step).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
    spine = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return lookup(spine, counts, [*keys, "bin"], how="left").select(
        *keys, "bin", left(F.col("bin")).alias("left"), right(F.col("bin")).alias("right"),
        F.coalesce("_c", F.lit(0)).alias("count"),
    )


def density(df: DataFrame, value: str, bins: int, keys: Sequence[str] = (), points: int = GRID_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott bandwidth, scaled to the counts of a `bins` histogram.

    A task adds up the kernels of its rows per series, so what is shuffled is one row per grid point,
    series and task.
    """
    data = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    span = materialise(
        _span(data, keys, "_v").filter(F.col("sd") > 0).select(
            *keys, "lo", "hi",
            (F.col("sd") * F.pow(F.col("n").cast("double"), -0.2)).alias("h"),
            ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"),
        )
    )
    keys = list(keys)
    met = attach(data, span, keys).select(*keys, "_v", "lo", "step", "h")

    def kernels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            series = batch.groupby(keys, dropna=False, sort=False).ngroup().to_numpy() if keys else np.zeros(len(batch), int)
            order = np.argsort(series, kind="stable")
            rows = batch.iloc[order]
            lo, step, h, v = (rows[c].to_numpy()[:, None] for c in ("lo", "step", "h", "_v"))
            z = (lo + step * np.arange(points) - v) / h
            starts = np.flatnonzero(np.diff(series[order], prepend=-1))
            added = np.add.reduceat(np.exp(-0.5 * z * z), starts, axis=0)
            names = list(rows.iloc[starts][keys].itertuples(index=False, name=None)) if keys else [()]
            for name, part in zip(names, added):
                sums[name] = sums[name] + part if name in sums else part
            if len(sums) > OPEN_SERIES:
                yield _kernel_rows(sums, keys)
                sums = {}
        if sums:
            yield _kernel_rows(sums, keys)

    schema = T.StructType([*[met.schema[k] for k in keys], T.StructField("point", T.IntegerType()), T.StructField("_k", T.DoubleType())])
    sums = met.mapInPandas(kernels, schema).groupBy(*keys, "point").agg(F.sum("_k").alias("_k"))
    grid = span.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = (F.col("hi") - F.col("lo")) / bins / (F.col("h") * F.sqrt(2 * F.pi()))
    return lookup(grid, sums, [*keys, "point"], how="left").select(
        *keys, "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
        (F.coalesce("_k", F.lit(0.0)) * scale).alias("density"),
    )


def _kernel_rows(sums: dict[tuple, np.ndarray], keys: list[str]) -> pd.DataFrame:
    points = len(next(iter(sums.values())))
    out = {k: [name[i] for name in sums for _ in range(points)] for i, k in enumerate(keys)}
    return pd.DataFrame({**out, "point": np.tile(np.arange(points), len(sums)), "_k": np.concatenate(list(sums.values()))})


def sample_ranks(df: DataFrame, value: str, keys: Sequence[str] = (), run_rows: int = RUN_ROWS) -> DataFrame:
    """`value_ranks` with one row per sample in `rank`.

    Where a single value is very frequent, its samples are cut into runs that spread over tasks
    before they become rows.
    """
    parts = distinct_values(df, value, keys)
    ranks = ranked(parts, keys)
    first, last = F.col("below") + 1, F.col("below") + F.col("count")
    if (parts.agg(F.max("count")).first()[0] or 0) > run_rows:
        runs = ranks.withColumn("_run", F.explode(F.sequence(first, last, F.lit(run_rows).cast("long"))))
        ranks = runs.repartition(*keys, "_run")
        first, last = F.col("_run"), F.least(last, F.col("_run") + run_rows - 1)
    return ranks.withColumn("rank", F.explode(F.sequence(first, last))).drop("_run")


def empirical_cdf(df: DataFrame, value: str = "load", keys: Sequence[str] = ()) -> DataFrame:
    """One row per sample in value order: `keys…, rank, value, ecdf`; equal values keep separate steps."""
    return sample_ranks(df, value, keys).select(
        *keys, "rank", "value", (F.col("rank") / F.col("n")).alias("ecdf")
    )


# The coefficients of algorithm AS 241 (Wichura 1988) for the normal quantile, numerators and denominators
# in rising powers, for the middle, the near tails and the far tails.
NORMAL_MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
NORMAL_NEAR = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
NORMAL_FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(x: Column, coefficients: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    def horner(values: tuple[float, ...]) -> Column:
        total = F.lit(values[-1])
        for v in reversed(values[:-1]):
            total = total * x + F.lit(v)
        return total

    return horner(coefficients[0]) / horner(coefficients[1])


def normal_quantile(p: Column) -> Column:
    """The quantile of the standard normal distribution, to about sixteen digits; NULL outside 0 to 1."""
    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(tail <= 5, _ratio(tail - 1.6, NORMAL_NEAR)).otherwise(_ratio(tail - 5.0, NORMAL_FAR))
    inner = q * _ratio(F.lit(0.180625) - q * q, NORMAL_MIDDLE)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, inner).otherwise(F.when(q < 0, -outer).otherwise(outer)))


def normal_qq(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Ordered samples against normal quantiles at Filliben's order-statistic medians."""
    i, n = F.col("rank"), F.col("n")
    edge = F.pow(F.lit(0.5), 1.0 / n)
    median = F.when(i == n, edge).when(i == 1, 1 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return sample_ranks(df, value, keys).select(
        *keys, "rank", normal_quantile(median).alias("theoretical"), F.col("value").alias("sample")
    )


def normal_qq_fit(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line through Q-Q points."""
    return points.groupBy(*keys).agg(
        F.regr_slope("sample", "theoretical").alias("slope"),
        F.regr_intercept("sample", "theoretical").alias("intercept"),
        F.corr("sample", "theoretical").alias("r"),
    )
