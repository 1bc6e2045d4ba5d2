"""Time buckets that are in UTC whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_MICROS_PER_DAY = 86_400_000_000
_MICROS_PER_HOUR = 3_600_000_000


def _floor_to(ts: Column, micros: int) -> Column:
    since_epoch = F.unix_micros(ts)
    return F.timestamp_micros(since_epoch - F.pmod(since_epoch, F.lit(micros)))


def utc_hour(ts: Column) -> Column:
    """Start of the UTC hour of an instant."""
    return _floor_to(ts, _MICROS_PER_HOUR)


def utc_second(ts: Column) -> Column:
    """An instant narrowed to whole seconds."""
    return _floor_to(ts, 1_000_000)


def utc_date(ts: Column) -> Column:
    """UTC calendar date of an instant."""
    micros = F.unix_micros(ts)
    whole_days = (micros - F.pmod(micros, F.lit(_MICROS_PER_DAY))) / F.lit(_MICROS_PER_DAY)
    return F.date_from_unix_date(whole_days.cast("int"))


def day_number(date: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def as_instant(value: Column | str | None) -> Column:
    """``value`` as a timestamp column; the current time when it is None."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value.cast("timestamp")
    return F.lit(value).cast("timestamp")
