"""Time columns: local time, stable dates, date ranges. ``now`` is always an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

FORECAST_DAYS = 7
HISTORY_YEARS = 10


def instant(now: datetime | str | Column) -> Column:
    """``now`` (UTC) as a timestamp without zone."""
    if isinstance(now, Column):
        return now
    text = now.isoformat(sep=" ") if isinstance(now, datetime) else now
    return F.lit(text).cast("timestamp_ntz")


def seconds(n: Column | int) -> Column:
    value = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(secs=value.cast("decimal(18,6)"))


def local_time(utc: Column, offset_seconds: Column) -> Column:
    """UTC shifted by a fixed offset."""
    return utc + seconds(offset_seconds)


def local_time_in_zone(utc: Column, zone_name: Column) -> Column:
    """UTC as the clock of a political time zone shows it."""
    return F.convert_timezone(F.lit("UTC"), zone_name, utc)


def earliest_current_date(now) -> Column:
    """The date it is in the zone that lags most: today once 12:00 UTC is past, else yesterday."""
    t = instant(now)
    day = F.to_date(t)
    noon = F.date_trunc("DAY", t).cast("timestamp_ntz") + F.expr("interval 12 hours")
    return F.when(t > noon, day).otherwise(F.date_sub(day, 1))


def last_forecast_date(now, days: int = FORECAST_DAYS) -> Column:
    return F.date_add(earliest_current_date(now), days)


def dates_between(first: Column, last: Column) -> Column:
    """Array of all dates from ``first`` to ``last``, both included; empty when reversed."""
    first, last = F.to_date(first), F.to_date(last)
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def first_unstable_date(local_request: Column) -> Column:
    """The first date whose values were not final yet at a local request time."""
    return F.to_date(local_request - F.expr("interval 1 day"))


def end_of_day_utc(day: Column, offset_seconds: Column) -> Column:
    """23:59:59 local of ``day``, in UTC."""
    end = F.to_date(day).cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second")
    return end - seconds(offset_seconds)
