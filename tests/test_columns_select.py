from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridtide.functions import columns
from gridtide.functions.calendar import add_time_features, micros
from gridtide.operators import select
from tests.helpers import frame, times, walk


def test_names():
    assert columns.normalise_name("  Load MW ") == "loadmw"
    found = columns.match_weather_columns(["timestamp", "load", "最高温度℃", "平均温度℃", "相对湿度(平均)", "降雨量（mm）"])
    assert found == {"temperature": "平均温度℃", "humidity": "相对湿度(平均)", "rainfall": "降雨量（mm）"}
    assert columns.match_weather_columns(["timestamp", "load", "Temp"]) == {"temperature": "Temp"}


def test_infer_by_name_and_content(spark):
    named = spark.createDataFrame([("2018/1/1 0:00", "1", "2")], "`采样时间` string, `有功` string, x string")
    assert columns.infer_key_columns(named) == columns.KeyColumns("采样时间", "有功")
    blind = spark.createDataFrame([("a", "2018/1/1 0:00", "5"), ("b", "2018/1/2 0:00", "x")], "p string, q string, r string")
    assert columns.infer_key_columns(blind) == columns.KeyColumns("q", "r")
    with pytest.raises(ValueError):
        columns.infer_key_columns(named.limit(0))
    with pytest.raises(ValueError):
        columns.infer_key_columns(spark.createDataFrame([("1",)], "load_time string"))


def test_exogenous_columns(spark):
    df = add_time_features(spark.createDataFrame([(datetime(2024, 1, 6), 1.0, 2.0, "s")], "timestamp timestamp_ntz, load double, t double, k string"))
    names = columns.numeric_exogenous_columns(df, ("k",))
    assert len(names) == 14 and names[0] == "t" and "is_weekend" in names and "season" not in names


def test_micros_is_wall_clock(spark):
    moment = datetime(2024, 3, 10, 2, 30, 1, 123456)
    want = int((moment - datetime(1970, 1, 1)).total_seconds()) * 1_000_000 + 123456
    df = spark.createDataFrame([(moment,)], "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(micros("t")).first()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture(scope="module")
def month(spark):
    return frame(spark, {"a": walk(720)}, {"a": times(720)})


def test_ranges(month):
    every = select.resolve_time_range(month, mode="all")
    assert every.label == "all_data" and not every.clipped
    week = select.resolve_time_range(month, mode="range", start="2024-01-02", end="2024-01-09")
    assert (week.end - week.start).days == 7 and week.label == "202401020000_202401090000"
    assert select.filter_by_time(month, week).count() == 169
    clipped = select.resolve_time_range(month, mode="range", start="2023-01-01", end="2024-01-09T00:00:00+00:00")
    assert clipped.clipped and clipped.start == datetime(2024, 1, 1)
    recent = select.resolve_time_range(month, mode="recent", recent_value=1, recent_unit="weeks")
    assert recent.start == datetime(2024, 1, 23, 23)


@pytest.mark.parametrize("arguments", [
    {"mode": "range", "start": "2024-01-02"},
    {"mode": "range", "start": "2024-01-09", "end": "2024-01-02"},
    {"mode": "range", "start": "2025-01-09", "end": "2025-02-02"},
    {"mode": "range", "start": "2024-01-02", "end": "2024-01-08T23:59"},
    {"mode": "recent", "recent_value": 0, "recent_unit": "days"},
    {"mode": "recent", "recent_value": 9, "recent_unit": "months"},
    {"mode": "recent", "recent_value": 6, "recent_unit": "days"},
    {"mode": "other"},
])
def test_bad_ranges(month, arguments):
    with pytest.raises(select.TimeRangeError):
        select.resolve_time_range(month, **arguments)


def test_empty_selection_is_an_error(month):
    week = select.resolve_time_range(month, mode="range", start="2024-01-02", end="2024-01-09")
    with pytest.raises(select.TimeRangeError):
        select.filter_by_time(month.filter(F.col("timestamp") > "2024-01-20"), week)


def test_range_reaches_the_scan(spark, month, tmp_path):
    month.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    week = select.resolve_time_range(stored, mode="range", start="2024-01-02", end="2024-01-09")
    plan = stored.filter(select.in_range(week))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan


def test_short_years_and_bare_digits(spark):
    from gridtide.functions.columns import KeyColumns, infer_key_columns, to_timestamp

    cells = {
        "2018/1/1 0:00": "2018-01-01 00:00:00", "2018-1-2 3:04:05": "2018-01-02 03:04:05", "2018/1/3": "2018-01-03 00:00:00", "2018-1-4": "2018-01-04 00:00:00",
        "1/2/18": "2018-01-02 00:00:00", "1/2/18 5:06": "2018-01-02 05:06:00", "18-1-2": "2018-01-02 00:00:00", "1/2/2018 5:06:07": "2018-01-02 05:06:07", "12/31/99": "1999-12-31 00:00:00",
        "201801020304": "2018-01-02 03:04:00", "20180102": "2018-01-02 00:00:00", "2018-01-02T03:04:05": "2018-01-02 03:04:05",
        "3512": None, "12345": None, "99999999": None, "18/13/40": None, "0018-01": None, "x": None, "": None,
    }
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r.c: r.t for r in df.select("c", to_timestamp(F.col("c"), df.schema["c"].dataType).cast("string").alias("t")).collect()}
    assert got == cells
    plain = spark.createDataFrame([("3512", "18-1-2"), ("4100", "18-1-3")], "a string, b string")
    assert infer_key_columns(plain) == KeyColumns("b", "a")
