"""Timestamp expressions.  All of them use the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.codes import DATE_FORMAT, TIME_FORMAT


def as_time(text: Column) -> Column:
    """Text or timestamp to ``TIMESTAMP``; unreadable text becomes null."""
    return text.try_cast("timestamp")


def millis_to_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ymd(ts: Column) -> Column:
    """``yyyy-MM-dd`` text."""
    return F.date_format(ts, DATE_FORMAT)


def ymd_hms(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(ts, TIME_FORMAT)


def date_id(text: Column) -> Column:
    """Day text of a timestamp given as text."""
    return ymd(as_time(text))


def wall_clock_millis() -> Column:
    return F.unix_millis(F.current_timestamp())
