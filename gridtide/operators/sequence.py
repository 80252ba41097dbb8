"""Rolling means, supervised windows, the train/test split and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.operators.position import BLOCK_ROWS, block_window, home_rows, with_halo
from gridtide.operators.skew import attach


def reach(window: int) -> tuple[int, int]:
    """Rows before and after the centre of a centred window; an even window leans back."""
    return window // 2, window - 1 - window // 2


def rolling_mean(
    indexed: DataFrame, window: int, keys: Sequence[str] = (), value: str = "load", out: str = "smooth",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Centred moving average, shortened at both ends of the series."""
    before, after = reach(window)
    frame = block_window(keys).rowsBetween(-before, after)
    return home_rows(with_halo(indexed, before, after, block_rows).withColumn(out, F.avg(value).over(frame)), block_rows)


def sliding_windows(
    indexed: DataFrame, lookback: int, horizon: int, keys: Sequence[str] = (), value: str = "load",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """`x` (the last `lookback` values) and `y` (the next `horizon`) at every position that has both."""
    order = block_window(keys)
    framed = with_halo(indexed, lookback - 1, horizon, block_rows).withColumns({
        "x": F.collect_list(value).over(order.rowsBetween(-(lookback - 1), 0)),
        "y": F.collect_list(value).over(order.rowsBetween(1, horizon)),
    })
    whole = (F.col("idx") >= lookback - 1) & (F.col("idx") < F.col("n") - horizon)
    return home_rows(framed, block_rows).filter(whole).withColumnRenamed("idx", "origin_idx")


def split_position(train_ratio: float, lookback: int, horizon: int) -> Column:
    """First test position: the training share of the rows, but at least one whole window."""
    share = F.floor(F.col("n") * F.lit(float(train_ratio)))
    return F.greatest(share, F.lit(lookback + horizon).cast("long"))


def with_split(indexed: DataFrame, train_ratio: float, lookback: int, horizon: int) -> DataFrame:
    return indexed.withColumn("split_idx", split_position(train_ratio, lookback, horizon))


def too_short(split: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Series whose rows cannot hold a training window and a test window."""
    return split.filter(F.col("split_idx") >= F.col("n")).select(*keys, "n").distinct()


def test_context(split: DataFrame, lookback: int) -> DataFrame:
    """Test rows and the `lookback` rows before them."""
    return split.filter(F.col("idx") >= F.col("split_idx") - lookback)


def scaling_table(split: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Mean and population deviation of the training rows, one row per series.

    A column that is constant in training gets deviation 1; `strict` keeps the tiny offset instead,
    which blows such a column up as soon as it moves in the test rows.
    """
    stats = []
    for c in columns:
        sd = F.stddev_pop(F.col(c).cast("double"))
        # Fixed value: the offset that keeps a deviation above zero.
        scale = sd + F.lit(1e-8)
        stats.append(F.avg(F.col(c).cast("double")).alias(f"mean_{c}"))
        stats.append((scale if strict else F.when(sd > 0, scale).otherwise(F.lit(1.0))).alias(f"scale_{c}"))
    return split.filter(F.col("idx") < F.col("split_idx")).groupBy(*keys).agg(*stats)


def standardise(split: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Replace columns by their z-scores under the training statistics, which stay as `mean_*`, `scale_*`."""
    scaled = attach(split, scaling_table(split, columns, keys, strict), keys)
    return scaled.withColumns({c: (F.col(c).cast("double") - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in columns})


def impute_means(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Fill gaps with the series mean over all rows, or 0 where the whole column is missing."""
    means = df.groupBy(*keys).agg(*[F.avg(F.col(c).cast("double")).alias(f"_mean_{c}") for c in columns])
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}"), F.lit(0.0)) for c in columns}
    return attach(df, means, keys).withColumns(filled).drop(*[f"_mean_{c}" for c in columns])


def average_overlaps(predictions: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per target: the mean of all windows' predictions and the true value.

    Where the rows have `hits`, `pred` is the sum of so many predictions.
    """
    mean = F.sum("pred") / F.nullif(F.sum("hits"), F.lit(0)) if "hits" in predictions.columns else F.avg("pred")
    return predictions.groupBy(*groups, F.col("target_idx").alias("idx")).agg(F.max("truth").alias("actual"), mean.alias("predicted"))
