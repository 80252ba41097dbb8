"""Time-range selection and row predicates on clock and calendar."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.calendar import micros
from gridtide.functions.holidays import china_holidays
from gridtide.operators.skew import attach

MIN_SPAN = timedelta(days=7)
PEAK_HOURS = (18, 21)
VALLEY_HOURS = (2, 4)


class TimeRangeError(ValueError):
    """The wanted range cannot be used with the data."""


@dataclass(frozen=True)
class TimeRange:
    mode: str
    start: datetime
    end: datetime
    label: str
    description: str
    clipped: bool = False


def _wall_clock(value: str | datetime) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def time_bounds(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    column = F.col(ts).cast("timestamp_ntz")
    return df.agg(F.min(column).alias("start"), F.max(column).alias("end"))


def resolve_time_range(
    df: DataFrame,
    *,
    mode: str,
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    recent_value: int | None = None,
    recent_unit: str | None = None,
    ts: str = "timestamp",
) -> TimeRange:
    """Turn `all`, `range` or `recent` into bounds inside the data; one min/max aggregate is read."""
    data_start, data_end = time_bounds(df, ts).first()
    if data_start is None:
        raise TimeRangeError("The table has no usable timestamps.")
    if mode == "all":
        return TimeRange(mode, data_start, data_end, "all_data", f"all data: {data_start} ~ {data_end}")
    if mode == "range":
        if not start or not end:
            raise TimeRangeError("A custom range needs a start and an end.")
        wanted = (_wall_clock(start), _wall_clock(end))
        if wanted[0] > wanted[1]:
            raise TimeRangeError("The start is later than the end.")
    elif mode == "recent":
        if not recent_value or recent_value <= 0:
            raise TimeRangeError("A recent range needs a length above 0.")
        if recent_unit not in ("days", "weeks"):
            raise TimeRangeError("The unit of a recent range is days or weeks.")
        wanted = (data_end - timedelta(**{recent_unit: recent_value}), data_end)
    else:
        raise TimeRangeError(f"Unknown range mode: {mode}")

    if wanted[1] < data_start or wanted[0] > data_end:
        raise TimeRangeError("The range lies outside the data.")
    first, last = max(wanted[0], data_start), min(wanted[1], data_end)
    clipped = (first, last) != wanted
    if last - first < MIN_SPAN:
        raise TimeRangeError("The range is shorter than 7 days.")
    label = f"{first:%Y%m%d%H%M}_{last:%Y%m%d%H%M}"
    note = " (clipped to the data)" if clipped else ""
    return TimeRange(mode, first, last, label, f"{first} ~ {last}{note}", clipped)


def resolve_time_ranges(
    df: DataFrame, keys: Sequence[str], *, mode: str, start: str | datetime | None = None, end: str | datetime | None = None,
    recent_value: int | None = None, recent_unit: str | None = None, ts: str = "timestamp",
) -> DataFrame:
    """The same for every series by its own first and last time: `keys…, start, end, clipped, problem`.

    Requests that are wrong for any data are errors; a series that ended before the range, begins after it or has less than seven days
    of it is not one: it keeps its row, and `problem` says why it is left out (else NULL). `recent` counts back from the end of each series.
    """
    bounds = df.groupBy(*keys).agg(F.min(ts).cast("timestamp_ntz").alias("_first"), F.max(ts).cast("timestamp_ntz").alias("_last"))
    if mode == "all":
        low, high, least = F.col("_first"), F.col("_last"), False
    elif mode == "range":
        if not start or not end:
            raise TimeRangeError("A custom range needs a start and an end.")
        wanted = (_wall_clock(start), _wall_clock(end))
        if wanted[0] > wanted[1]:
            raise TimeRangeError("The start is later than the end.")
        low, high, least = *(F.lit(w).cast("timestamp_ntz") for w in wanted), True
    elif mode == "recent":
        if not recent_value or recent_value <= 0:
            raise TimeRangeError("A recent range needs a length above 0.")
        if recent_unit not in ("days", "weeks"):
            raise TimeRangeError("The unit of a recent range is days or weeks.")
        days = recent_value * (7 if recent_unit == "weeks" else 1)
        low, high, least = F.col("_last") - F.make_dt_interval(F.lit(days)), F.col("_last"), True
    else:
        raise TimeRangeError(f"Unknown range mode: {mode}")
    ranged = bounds.withColumns({"_low": low, "_high": high})
    ranged = ranged.withColumns({"start": F.greatest("_low", "_first"), "end": F.least("_high", "_last")})
    apart = (F.col("_high") < F.col("_first")) | (F.col("_low") > F.col("_last"))
    span = F.lit(int(MIN_SPAN.total_seconds() * 10**6)).cast("long")
    short = F.lit(least) & (micros("end") - micros("start") < span)
    problem = F.when(F.col("_first").isNull(), "no usable timestamps").when(apart, "outside the data").when(short, "shorter than 7 days")
    return ranged.select(*keys, "start", "end", ((F.col("start") > F.col("_low")) | (F.col("end") < F.col("_high"))).alias("clipped"), problem.alias("problem"))


def filter_by_times(df: DataFrame, ranges: DataFrame, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """Rows inside the range of their series, both ends included; series with a problem have none."""
    usable = ranges.filter("problem IS NULL").select(*keys, F.col("start").alias("_start"), F.col("end").alias("_end"))
    return attach(df, usable, keys).filter(F.col(ts).between(F.col("_start"), F.col("_end"))).drop("_start", "_end")


def in_range(selection: TimeRange, ts: str = "timestamp") -> Column:
    return F.col(ts).between(F.lit(selection.start).cast("timestamp_ntz"), F.lit(selection.end).cast("timestamp_ntz"))


def filter_by_time(df: DataFrame, selection: TimeRange, ts: str = "timestamp") -> DataFrame:
    """Rows inside the range, both ends included; an empty result is an error."""
    kept = df.filter(in_range(selection, ts))
    if kept.isEmpty():
        raise TimeRangeError("No rows are left in the range.")
    return kept


def is_peak_hour(ts: str = "timestamp") -> Column:
    return F.hour(ts).between(*PEAK_HOURS)


def is_valley_hour(ts: str = "timestamp") -> Column:
    return F.hour(ts).between(*VALLEY_HOURS)


def on_day(df: DataFrame, day: date, ts: str = "timestamp") -> DataFrame:
    """One calendar day, as a range on the raw column so that a scan can skip the other days."""
    begin = datetime(day.year, day.month, day.day)
    stop = begin + timedelta(days=1)
    return df.filter((F.col(ts) >= F.lit(begin).cast("timestamp_ntz")) & (F.col(ts) < F.lit(stop).cast("timestamp_ntz")))


def holiday_table(df: DataFrame, ts: str = "timestamp", shifts: DataFrame | None = None) -> DataFrame:
    """`date, name` of the public holidays of China in the years that the rows have, a dozen for each year.

    `shifts` has `date, holiday`: days declared off (true) or working days (false) by decree, which the rules do not know.
    """
    first, last = (t.year if t else None for t in time_bounds(df, ts).first())
    rows = china_holidays(first, last) if first else []
    days = df.sparkSession.createDataFrame(rows, "date date, name string")
    if shifts is None:
        return days
    decreed = shifts.select(F.col("date").cast("date").alias("date"), F.col("holiday").alias("_off")).distinct()
    kept = days.join(decreed.select("date"), "date", "left_anti")
    return kept.unionByName(decreed.filter("_off").select("date", F.lit("Decreed").alias("name")))


def flag_holidays(df: DataFrame, holidays: DataFrame | None = None, ts: str = "timestamp") -> DataFrame:
    """Add `is_holiday` from a table with a `date` column of public holidays; without one, from those of China."""
    holidays = holiday_table(df, ts) if holidays is None else holidays
    days = holidays.select(F.col("date").cast("date").alias("_day")).distinct().withColumn("is_holiday", F.lit(True))
    marked = attach(df.withColumn("_day", F.to_date(ts)), days, ["_day"], how="left")
    return marked.withColumn("is_holiday", F.coalesce("is_holiday", F.lit(False))).drop("_day")
