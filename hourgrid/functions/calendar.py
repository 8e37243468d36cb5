"""Calendar expressions on timestamps and on the yyyyMMddHH hour key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def time_key(ts: Column) -> Column:
    """yyyyMMddHH as a long. Integer arithmetic, so no text is formatted and parsed per row."""
    return (
        F.year(ts).cast("long") * 1_000_000
        + F.month(ts).cast("long") * 10_000
        + F.dayofmonth(ts).cast("long") * 100
        + F.hour(ts).cast("long")
    )


def year_of_key(key: Column) -> Column:
    return _div(key, 1_000_000).cast("int")


def month_of_key(key: Column) -> Column:
    return (_div(key, 10_000) % 100).cast("int")


def day_of_key(key: Column) -> Column:
    return (_div(key, 100) % 100).cast("int")


def hour_of_key(key: Column) -> Column:
    return (key % 100).cast("int")


def date_of_key(key: Column) -> Column:
    return F.make_date(year_of_key(key), month_of_key(key), day_of_key(key))


def time_of_key(key: Column) -> Column:
    parts = (year_of_key(key), month_of_key(key), day_of_key(key), hour_of_key(key))
    return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))


def iso_weekday(ts: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(ts) + 1


def calendar_parts(ts: Column) -> list[Column]:
    """The calendar columns of the time dimension, named."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        iso_weekday(ts).alias("day_of_week"),
        F.quarter(ts).alias("quarter"),
    ]


def period_label(grain: str, year: Column, month: Column, date: Column) -> Column:
    """Chart label of a period: yyyy, yyyy-MM or yyyy-MM-dd."""
    if grain == "day":
        return date.cast("string")
    if grain == "month":
        return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
    return year.cast("string")


def key_in_years(key: Column, start_year: int, end_year: int) -> Column:
    """Year range as a range of hour keys: a plain comparison that reaches the Parquet scan."""
    return key.between(F.lit(start_year * 1_000_000).cast("long"), F.lit((end_year + 1) * 1_000_000 - 1).cast("long"))


def on_day(ts: Column, day: Column) -> Column:
    """``day`` as a half-open timestamp range, which reaches the scan where ``to_date`` does not."""
    return (ts >= day.cast("timestamp_ntz")) & (ts < F.date_add(day, 1).cast("timestamp_ntz"))


def hours(n: Column | int) -> Column:
    """Interval of ``n`` hours."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), n.cast("int"))
