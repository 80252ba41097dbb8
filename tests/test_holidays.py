from datetime import date

import pytest

from gridtide.functions import holidays as H
from gridtide.operators import select

# Published dates.
NEW_YEARS = """2000-02-05 2001-01-24 2002-02-12 2003-02-01 2004-01-22 2005-02-09 2006-01-29 2007-02-18 2008-02-07 2009-01-26 2010-02-14 2011-02-03 2012-01-23
2013-02-10 2014-01-31 2015-02-19 2016-02-08 2017-01-28 2018-02-16 2019-02-05 2020-01-25 2021-02-12 2022-02-01 2023-01-22 2024-02-10 2025-01-29 2026-02-17 2027-02-06
2028-01-26 2029-02-13 2030-02-03 2031-01-23 2032-02-11 2033-01-31 2034-02-19 2035-02-08 2036-01-28 2037-02-15 2038-02-04 2039-01-24 2040-02-12 2041-02-01 2042-01-22
2043-02-10 2044-01-30 2045-02-17 2046-02-06 2047-01-26 2048-02-14 2049-02-02 2050-01-23 1995-01-31 1996-02-19 1997-02-07 1998-01-28 1999-02-16""".split()
AUTUMNS = """2000-09-12 2001-10-01 2002-09-21 2003-09-11 2004-09-28 2005-09-18 2006-10-06 2007-09-25 2008-09-14 2009-10-03 2010-09-22 2011-09-12 2012-09-30 2013-09-19
2014-09-08 2015-09-27 2016-09-15 2017-10-04 2018-09-24 2019-09-13 2020-10-01 2021-09-21 2022-09-10 2023-09-29 2024-09-17 2025-10-06 2026-09-25 2027-09-15 2028-10-03
2029-09-22 2030-09-12""".split()
BOATS = """2008-06-08 2009-05-28 2010-06-16 2011-06-06 2012-06-23 2013-06-12 2014-06-02 2015-06-20 2016-06-09 2017-05-30 2018-06-18 2019-06-07 2020-06-25 2021-06-14
2022-06-03 2023-06-22 2024-06-10 2025-05-31 2026-06-19 2027-06-09 2028-05-28 2029-06-16 2030-06-05""".split()
TOMBS = [4, 4, 5, 5, 4, 4, 5, 5, 4, 4, 5, 5, 4, 4, 5, 5, 4, 4, 5, 5, 4, 4, 5]  # of April, 2008 to 2030


def days(year, name):
    return [d for d, n in H.china_holidays(year, year) if n == name]


def test_lunar_new_year():
    for text in NEW_YEARS:
        day = date.fromisoformat(text)
        assert H.lunar_months(day.year)[1] == day


def test_other_lunar_and_solar_days():
    for text in AUTUMNS:
        day = date.fromisoformat(text)
        assert (day - H.lunar_months(day.year)[8]).days == 14
    for text in BOATS:
        assert days(int(text[:4]), "Dragon Boat Festival") == [date.fromisoformat(text)]
    assert [days(2008 + i, "Tomb-Sweeping Day")[0].day for i in range(23)] == TOMBS


def test_rules_of_the_years():
    assert days(2007, "Labour Day") == [date(2007, 5, d) for d in (1, 2, 3)] and len(days(2008, "Labour Day")) == 1 and len(days(2025, "Labour Day")) == 2
    assert days(2024, "Spring Festival") == [date(2024, 2, d) for d in (10, 11, 12)] and days(2025, "Spring Festival")[0] == date(2025, 1, 28)
    assert len(days(1998, "National Day")) == 2 and len(days(1999, "National Day")) == 3 and not days(2007, "Mid-Autumn Festival")


def test_flags_without_a_table(spark):
    rows = [("2024-02-10 12:00:00",), ("2024-02-13 12:00:00",), ("2024-02-04 08:00:00",), ("2025-10-06 00:00:00",), (None,)]
    df = spark.createDataFrame(rows, "timestamp string").selectExpr("CAST(timestamp AS timestamp_ntz) AS timestamp")
    flags = {str(r.timestamp)[:10]: r.is_holiday for r in select.flag_holidays(df).collect()}
    assert flags == {"2024-02-10": True, "2024-02-13": False, "2024-02-04": False, "2025-10-06": True, "None": False}
    shifts = spark.createDataFrame([("2024-02-13", True), ("2024-02-10", False)], "date string, holiday boolean")
    flags = {str(r.timestamp)[:10]: r.is_holiday for r in select.flag_holidays(df, select.holiday_table(df, shifts=shifts)).collect()}
    assert flags["2024-02-13"] and not flags["2024-02-10"] and flags["2025-10-06"]
    assert select.flag_holidays(df.limit(0)).count() == 0


def test_ranges_by_series(spark):
    rows = [("a", "2024-01-01"), ("a", "2024-02-01"), ("b", "2024-01-28"), ("b", "2024-02-01"), ("c", "2023-01-01"), ("c", "2023-03-01"), ("d", None)]
    df = spark.createDataFrame(rows, "k string, t string").selectExpr("k", "CAST(t AS timestamp_ntz) AS timestamp")
    found = {r.k: r for r in select.resolve_time_ranges(df, ["k"], mode="range", start="2024-01-10", end="2024-03-01").collect()}
    assert [found[k].problem for k in "abcd"] == [None, "shorter than 7 days", "outside the data", "no usable timestamps"]
    assert found["a"].clipped and str(found["a"].start) == "2024-01-10 00:00:00" and str(found["a"].end) == "2024-02-01 00:00:00"
    recent = select.resolve_time_ranges(df, ["k"], mode="recent", recent_value=2, recent_unit="weeks")
    found = {r.k: r for r in recent.collect()}
    assert [found[k].problem for k in "abc"] == [None, "shorter than 7 days", None] and str(found["c"].start) == "2023-02-15 00:00:00"
    assert sorted(r.k for r in select.filter_by_times(df, recent, ["k"]).collect()) == ["a", "c"]
    assert {r.problem for r in select.resolve_time_ranges(df, ["k"], mode="all").collect()} == {None, "no usable timestamps"}
    for bad in ({"mode": "range"}, {"mode": "recent", "recent_value": 0}, {"mode": "recent", "recent_value": 1, "recent_unit": "years"}, {"mode": "some"}, {"mode": "range", "start": "2024-02-01", "end": "2024-01-01"}):
        with pytest.raises(select.TimeRangeError):
            select.resolve_time_ranges(df, ["k"], **bad)
