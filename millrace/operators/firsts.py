"""First visits: per day, ever, and after a pause."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_first


def daily_first(df: DataFrame, key: Column, time: Column, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first row of each key and day, with all its columns; null keys are left out."""
    keyed = df.where(key.isNotNull() & time.isNotNull()).withColumn("_time", time)
    return dedup_first(keyed, [key, F.to_date("_time")], "_time", tie_break).drop("_time")


def first_ever(df: DataFrame, key: Column, time: Column, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first row of each key; null keys are left out."""
    keyed = df.where(key.isNotNull() & time.isNotNull()).withColumn("_time", time)
    return dedup_first(keyed, [key], "_time", tie_break).drop("_time")


def daily_visits(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``<keys>, visit_date, first_time``: when each key first appeared on each day.

    A plain ``min`` per key and day, combined before the shuffle.  Where only the
    time of the first row matters (all user counts per window) this replaces
    keeping the rows themselves.
    """
    present = F.col(time).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys, F.to_date(time).alias("visit_date"))
        .agg(F.min(time).alias("first_time"))
    )


def with_visit_history(visits: DataFrame, key: str) -> DataFrame:
    """Add ``gap_days`` since the previous visit day; null means the first visit ever.

    The input holds one row per key and day, so a group is bounded by the number
    of days, however many rows a key had.
    """
    by_day = Window.partitionBy(key).orderBy("visit_date")
    return visits.withColumn(
        "gap_days", F.datediff("visit_date", F.lag("visit_date").over(by_day))
    )
