"""Calendar columns derived from a wall-clock timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Months of the named seasons; every other month is Winter.
SEASON_MONTHS = {"Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
SEASON_ORDER = ("Spring", "Summer", "Autumn", "Winter")

CALENDAR_FEATURES = (
    "year", "month", "day", "hour", "minute", "weekday", "is_weekend",
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos",
)


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970-01-01 of the wall clock, whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.call_function("div", since, F.expr("INTERVAL '0.000001' SECOND"))


def season(month: Column) -> Column:
    chosen = None
    for name, months in SEASON_MONTHS.items():
        test = month.isin(*months)
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    return chosen.otherwise("Winter")


def _cycle(position: Column, period: float) -> tuple[Column, Column]:
    angle = 2 * F.pi() * position / F.lit(period)
    return F.sin(angle), F.cos(angle)


def year_week(ts: Column | str) -> Column:
    """`YYYY-WW` with Monday weeks; days before the first Monday belong to week 00."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    week = F.floor((F.dayofyear(ts) + 6 - F.weekday(ts)) / 7).cast("int")
    return F.concat(F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def range_label(start: Column, end: Column) -> Column:
    return F.concat_ws("_", F.date_format(start, "yyyyMMddHHmm"), F.date_format(end, "yyyyMMddHHmm"))


def calendar_columns(ts: Column | str = "timestamp") -> dict[str, Column]:
    ts = F.col(ts) if isinstance(ts, str) else ts
    hour_sin, hour_cos = _cycle(F.hour(ts) + F.minute(ts) / 60.0, 24.0)
    weekday_sin, weekday_cos = _cycle(F.weekday(ts), 7.0)
    month_sin, month_cos = _cycle(F.month(ts) - 1, 12.0)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "weekday": F.weekday(ts),
        "weekday_name": F.date_format(ts, "EEEE"),
        "is_weekend": F.weekday(ts) >= 5,
        "date": F.to_date(ts),
        "season": season(F.month(ts)),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "weekday_sin": weekday_sin,
        "weekday_cos": weekday_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }


def add_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the calendar columns; a raw column of the same name is overwritten."""
    return df.withColumns(calendar_columns(ts))
