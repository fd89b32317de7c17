"""Per-window totals together with first-visit counts in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from millrace.functions.times import ymd_hms


def windows_with_first_visits(
    df: DataFrame,
    key: str,
    time: str,
    size: str,
    totals: Sequence[Column] = (),
    visit: Column | None = None,
) -> GroupedData:
    """Rows grouped by window (``stt``, ``edt``), ready for ``agg``.

    The grouped rows are of two kinds: one per window with the ``totals`` over
    all its rows, and one per key and day (``is_visit``) with ``gap_days`` since
    the key's previous day, placed in the window of its first row that day.
    ``visit`` restricts which rows count as visits.  Rows without a key are left out.

    Both kinds come from one scan and one shuffle by grouping sets, combined
    before the shuffle; no step holds all rows of a key or of a window.
    """
    counts = F.lit(True) if visit is None else F.coalesce(visit, F.lit(False))
    by_kind = (
        df.where(F.col(time).isNotNull() & F.col(key).isNotNull())
        .withColumn("_window", F.window(time, size))
        .withColumn("_day", F.to_date(time))
        .withColumn("_key", F.when(counts, F.col(key)))
        .groupingSets([["_window"], ["_key", "_day"]], "_window", "_key", "_day")
        .agg(F.min(time).alias("_first"), F.grouping("_window").alias("_by_key"), *totals)
        .where((F.col("_by_key") == 0) | F.col("_key").isNotNull())
    )
    # window rows have no key: the window itself keeps them from forming one group
    history = Window.partitionBy("_key", "_window").orderBy("_day")
    is_visit = F.col("_by_key") == 1
    names = [c for c in by_kind.columns if not c.startswith("_")]
    return (
        by_kind.withColumn("is_visit", is_visit)
        .withColumn("gap_days", F.datediff("_day", F.lag("_day").over(history)))
        .withColumn("is_new", is_visit & F.lag("_day").over(history).isNull())
        .withColumn("_slot", F.coalesce(F.col("_window"), F.window("_first", size)))
        .select(
            ymd_hms(F.col("_slot.start")).alias("stt"),
            ymd_hms(F.col("_slot.end")).alias("edt"),
            "is_visit", "is_new", "gap_days",
            # totals of a visit row belong to the key, not to the window
            *[F.when(~is_visit, F.col(n)).alias(n) for n in names],
        )
        .groupBy("stt", "edt")
    )
