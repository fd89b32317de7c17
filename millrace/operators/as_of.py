"""Joins with the version that was in force at a record's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Length of a time slice; a task sorts one key's records of one slice.
SLICE_MS = 3_600_000


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    take: str,
    right_time: str | None = None,
    tie_break: Sequence[str] = (),
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Add the struct column ``take`` of the newest right row of the same keys at or before ``time``.

    Both times are milliseconds.  Of right rows of one time the greatest tie-break values
    count, then the greatest ``take``.  Left rows without an earlier version, without a key or
    a time get null and stay; right rows without key or time are never in force.  ``left`` has
    no column called ``take``.

    A key's history is cut into slices of time.  The newest version of each slice, a row per
    key and slice, is carried forward to the later slices of the key; within a slice records
    and versions are sorted together.  So a key with a third of all records is spread over its
    slices, and no interval is spelled out slot by slot.
    """
    right_time = right_time or time
    slot = lambda t: F.floor(F.col(t) / slice_ms).alias("_slice")
    known = right.where(F.col(right_time).isNotNull()).where(
        " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    )
    order = F.struct(F.col(right_time).alias("t"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(tie_break)], F.col(take).alias("v"))
    # one version per key and time: combined before its shuffle
    versions = known.groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max(order)["v"].alias("_v"))
    versions = versions.withColumn("_slice", F.floor(F.col("_t") / slice_ms))
    last = versions.groupBy(*keys, "_slice").agg(F.max_by("_v", "_t").alias("_last"))
    slices = last.unionByName(
        left.where(F.col(time).isNotNull()).select(*keys, slot(time)).distinct(), allowMissingColumns=True
    ).groupBy(*keys, "_slice").agg(F.first("_last", ignorenulls=True).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        *keys, "_slice", (F.col("_slice") * slice_ms - 1).alias("_t"),
        F.last("_last", ignorenulls=True).over(before).alias("_v"),
    ).where("_v IS NOT NULL")
    # versions come before records of the same time
    rows = F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row")
    sides = versions.select(*keys, "_slice", "_t", "_v", F.lit(0).alias("_side")).unionByName(
        carried.withColumn("_side", F.lit(0))
    ).unionByName(
        left.select(*keys, slot(time), F.col(time).alias("_t"), F.lit(1).alias("_side"), rows), allowMissingColumns=True
    )
    within = Window.partitionBy(*keys, "_slice").orderBy("_t", "_side")
    valid = F.last("_v", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, 0))
    usable = F.col("_t").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    return (
        sides.withColumn(take, F.when(usable, valid)).where("_side = 1").select("_row.*", take)
    )
