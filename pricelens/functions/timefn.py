"""Instant / epoch helpers.  The session zone is UTC (see session.ensure_utc)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch of a timestamp / timestamp_ntz (floor)."""
    return F.unix_seconds(ts.cast("timestamp"))


def instant(epoch_s: Column) -> Column:
    """Epoch seconds -> UTC timestamp."""
    return F.timestamp_seconds(epoch_s)


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def _micros_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def hours_between(later: Column, earlier: Column) -> Column:
    """Whole hours from ``earlier`` to ``later``, truncated toward zero like
    ``TIMESTAMP_DIFF(later, earlier, HOUR)`` (2 h 59 m -> 2)."""
    return (_micros_between(later, earlier) / F.lit(3_600_000_000)).cast("bigint")


def minutes_between(later: Column, earlier: Column) -> Column:
    return (_micros_between(later, earlier) / F.lit(60_000_000)).cast("bigint")


def local_to_utc(local_ts: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` -> UTC instant."""
    return F.to_utc_timestamp(local_ts.cast("timestamp"), zone)


def same_day(ts: Column, day: Column | str) -> Column:
    """``DATE(ts) = day`` as a half-open range so parquet can prune on it."""
    d = F.to_date(F.lit(day)) if isinstance(day, str) else day
    start = d.cast("timestamp")
    return (ts >= start) & (ts < F.date_add(d, 1).cast("timestamp"))


def to_ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")
