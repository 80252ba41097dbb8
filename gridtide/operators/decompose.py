"""Additive decomposition of a series into components of falling frequency."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from gridtide.operators.position import BLOCK_ROWS, with_halo
from gridtide.operators.sequence import reach
from gridtide.operators.sifting import sift_components

# Centred window lengths of the smoothing cascade, and the most components.
CASCADE = (4, 16, 48, 96, 192, 336, 672)
MAX_COMPONENTS = 10


def _smooth(values: np.ndarray, before: int, after: int) -> np.ndarray:
    """Moving average of the known values with shortened ends, from running sums in extended precision.

    It is unknown only where the whole window is.
    """
    known = ~np.isnan(values)
    sums = np.concatenate([[0], np.cumsum(np.where(known, values, 0), dtype=np.longdouble)])
    counts = np.concatenate([[0], np.cumsum(known)])
    at = np.arange(len(values))
    low, high = np.maximum(at - before, 0), np.minimum(at + after + 1, len(values))
    n = counts[high] - counts[low]
    return np.where(n > 0, (sums[high] - sums[low]) / np.maximum(n, 1), np.nan).astype(float)


def decompose(
    indexed: DataFrame, keys: Sequence[str] = (), value: str = "load", max_components: int = MAX_COMPONENTS,
    keep: int | None = None, causal: bool = False, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `imf_1…`: each is what one smoothing step of the cascade removes; the last is the trend.

    A window is used only on series longer than it, so short series have fewer components and NULLs.
    All steps share one shuffle: the rows of a block come with every neighbour that the whole cascade
    can reach, and one task smooths a block of bounded size. `keep` stops the cascade early; `causal`
    uses trailing windows. Windows pass over unknown values: where the value is NULL, so is `imf_1`, while the
    later components are NULL only where a whole window is.
    """
    windows = CASCADE[: max(1, max_components - 1)]
    count = min(len(windows) + 1, max_components)
    if keep is not None:
        count = min(count, keep)
    windows = windows[:count]
    frames = [(w - 1, 0) if causal else reach(w) for w in windows]
    names = [f"imf_{j}" for j in range(1, count + 1)]
    rows = with_halo(indexed, sum(f[0] for f in frames), sum(f[1] for f in frames), block_rows)

    def cascade(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx", kind="stable")
        level = block[value].to_numpy(dtype=float)
        size = int(block["n"].iloc[0])
        parts = {name: np.full(len(block), np.nan) for name in names}
        remaining = iter(names)
        for window, (before, after) in zip(windows, frames):
            if size <= window:
                break
            smooth = _smooth(level, before, after)
            parts[next(remaining)] = level - smooth
            level = smooth
        trend = next(remaining, None)
        if trend is not None:
            parts[trend] = level
        block = block.assign(**parts)
        return block[block["idx"] // block_rows == block["_block"]].drop(columns="_block")

    fields = [f for f in rows.schema.fields if f.name != "_block"] + [T.StructField(n, T.DoubleType()) for n in names]
    out = rows.groupBy(*keys, "_block").applyInPandas(cascade, T.StructType(fields))
    return out.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def component_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("imf_")]


def component_frame(
    indexed: DataFrame, components: int = 6, keys: Sequence[str] = (), value: str = "load", rest: str = "residual",
    causal: bool = False, block_rows: int = BLOCK_ROWS, method: str = "cascade",
) -> DataFrame:
    """The first `components` components and what they leave of the load, so that all sum to it.

    `method` is `cascade` (moving averages) or `sifting` (envelopes of extrema; never causal).
    """
    if method not in ("cascade", "sifting") or (causal and method == "sifting"):
        raise ValueError("The method is cascade or sifting, and only the cascade can be causal.")
    most = max(MAX_COMPONENTS, components)
    if method == "sifting":
        parts = sift_components(indexed, keys, value, most, components, block_rows=block_rows)
    else:
        parts = decompose(indexed, keys, value, most, components, causal, block_rows)
    total = sum((F.coalesce(c, F.lit(0.0)) for c in component_names(parts)), F.lit(0.0))
    return parts.withColumn(rest, F.col(value) - total)


def bounded_component_frame(
    indexed: DataFrame, components: int, keys: Sequence[str] = (), value: str = "load", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Like `component_frame`, but every series must have the wanted number (1 to 10) of components."""
    if not 1 <= components <= MAX_COMPONENTS:
        raise ValueError("The number of components must be between 1 and 10.")
    available = F.lit(1) + sum(((F.col("n") > w).cast("int") for w in CASCADE), F.lit(0))
    short = indexed.filter(available < components).select("n").first()
    if short is not None:
        raise ValueError(f"{components} components are wanted, but a series of {short['n']} rows has fewer.")
    return component_frame(indexed, components, keys, value, "remainder_component", block_rows=block_rows)


def components_long(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """`keep…, component, value`, without the components a series does not have."""
    return df.unpivot(list(keep), list(names), "component", "value").filter(F.col("value").isNotNull())


def reconstruct_bands(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add high (components 1-2), mid (3-4), low (5 up to the last but one) and trend (the last)."""

    def total(part: Sequence[str], minimum: int) -> Column:
        chosen = part if len(names) >= minimum else []
        return sum((F.col(c) for c in chosen), F.lit(0.0))

    return df.withColumns({
        "high": total(names[0:2], 1),
        "mid": total(names[2:4], 3),
        "low": total(names[4:-1], 6),
        "trend": F.col(names[-1]),
    })


def component_energy(df: DataFrame, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Energy, its share and the population deviation of every component, from one aggregate."""
    wide = df.groupBy(*keys).agg(
        *[F.sum(F.col(c) * F.col(c)).alias(f"_e_{c}") for c in names], *[F.stddev_pop(c).alias(f"_s_{c}") for c in names]
    )
    rows = F.inline(F.array(*[
        F.struct(F.lit(i).alias("index"), F.lit(c).alias("component"), F.col(f"_e_{c}").alias("energy"), F.col(f"_s_{c}").alias("volatility"))
        for i, c in enumerate(names, start=1)
    ]))
    long = wide.select(*keys, rows).filter(F.col("energy").isNotNull())
    total = F.sum("energy").over(Window.partitionBy(*keys))
    share = F.when(total != 0, F.col("energy") / F.nullif(total, F.lit(0.0))).otherwise(0.0)
    return long.withColumn("energy_ratio", share)
