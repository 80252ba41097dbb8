"""Small series and independent reference computations."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

START = datetime(2024, 1, 1)


def walk(n: int, seed: int = 0) -> np.ndarray:
    return np.round(np.cumsum(np.random.default_rng(seed).normal(size=n)) + 100, 4)


def times(n: int, minutes: float = 60, start: datetime = START) -> list[datetime]:
    return [start + timedelta(minutes=minutes * i) for i in range(n)]


def uneven_times(n: int, seed: int = 1) -> list[datetime]:
    gaps = np.random.default_rng(seed).integers(1, 5_000_000_000, size=n)
    return [START + timedelta(microseconds=int(u)) for u in np.cumsum(gaps)]


def frame(spark, series: dict, stamps: dict):
    rows = [(k, t, float(v)) for k in series for t, v in zip(stamps[k], series[k])]
    return spark.createDataFrame(rows, "k string, timestamp timestamp_ntz, load double")


def pandas_of(df, *order: str) -> pd.DataFrame:
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)
