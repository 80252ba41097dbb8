import numpy as np
import pandas as pd
import pytest

from gridtide.operators import clean
from tests.helpers import frame, pandas_of, uneven_times, walk

DIRTY = [
    ("2018/1/1 0:00", None, "9.0"),
    ("2018/1/2 0:00", "1", "abc"),
    ("2018/1/3 0:00", "x", "11.0"),
    ("2018/1/5 0:00", "4", "12.0"),
    ("2018/1/5 0:00", "6", None),
    ("not-a-date", "9", "1.0"),
    ("2018/1/9 0:00", None, "13.0"),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(DIRTY, "`时间` string, `负荷` string, exog string")


@pytest.mark.parametrize("cell_rows", [1_000_000, 1])
def test_dirty_table(dirty, cell_rows):
    unique = clean.average_duplicates(clean.drop_invalid_times(clean.coerce_columns(dirty, "时间", "负荷")))
    got = pandas_of(clean.interpolate_in_time(unique, cell_rows=cell_rows), "timestamp")
    assert got["timestamp"].dt.day.tolist() == [1, 2, 3, 5, 9]
    assert np.allclose(got["load"], [1, 1, 1 + 4 / 3, 5, 5])
    assert np.allclose(got["exog"], [9, 10, 11, 12, 13])


def test_quality_counts(dirty):
    quality = dict(clean.clean_load_data(dirty, "时间", "负荷").quality.collect())
    assert quality == {
        "raw_rows": 7, "invalid_timestamp_rows": 1, "invalid_load_rows": 3, "duplicated_timestamp_rows": 1,
        "remaining_missing_load": 0, "remaining_missing_features": 0, "cleaned_rows": 5,
    }


def test_wholly_missing_feature_stays_missing(spark):
    raw = spark.createDataFrame([("2024-01-01", "1", "a"), ("2024-01-02", "2", "b")], "time string, load string, note string")
    result = clean.clean_load_data(raw, "time", "load")
    assert dict(result.quality.collect())["remaining_missing_features"] == 2
    assert [r["note"] for r in result.frame.collect()] == [None, None]


@pytest.mark.parametrize("cell_rows", [1_000_000, 20, 1])
def test_interpolation_matches_pandas(spark, cell_rows):
    n = 500
    stamps, load = uneven_times(n, 7), walk(n, 8)
    holes = np.random.default_rng(9).random(n) < 0.7
    holes[:5] = holes[-5:] = True
    load[holes] = np.nan
    df = frame(spark, {"a": load}, {"a": stamps}).replace(float("nan"), None)
    got = pandas_of(clean.interpolate_in_time(df, ["k"], cell_rows=cell_rows), "timestamp")
    want = pd.Series(load, index=pd.DatetimeIndex(stamps)).interpolate(method="time", limit_direction="both").ffill().bfill()
    assert np.allclose(got["load"], want.to_numpy())


def test_number_and_time_cells(spark):
    raw = spark.createDataFrame(
        [("2018-01-01 00:15", "1e3"), ("2018/3/4", " 7 "), ("20180102", "2.5f"), ("x", "inf"), ("2018-01-03T10:00:00", "NaN")],
        "time string, load string",
    )
    got = clean.coerce_columns(raw, "time", "load").collect()
    assert [r["load"] for r in got] == [1000.0, 7.0, None, float("inf"), None]
    assert [str(r["timestamp"]) for r in got] == ["2018-01-01 00:15:00", "2018-03-04 00:00:00", "2018-01-02 00:00:00", "None", "2018-01-03 10:00:00"]
