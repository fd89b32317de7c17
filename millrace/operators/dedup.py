"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Length of a time slice in idle times.
SLICE_FACTOR = 32


def _one_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    # rank-and-filter with rank 1: Spark limits each group to one row per task
    # before the shuffle, so copies of a hot key are dropped where they are read
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dedup_latest(
    df: DataFrame, keys: Sequence[str | Column], version: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the greatest ``version``; ties go to the greatest tie-break values."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in (version, *tie_break)])


def dedup_first(
    df: DataFrame, keys: Sequence[str | Column], version: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the smallest ``version``; ties go to the smallest tie-break values."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in (version, *tie_break)])


def first_after_idle(
    df: DataFrame, keys: Sequence[str], time: str, version: str, idle_ms: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The first row of each key by ``time``, and again after ``idle_ms`` without a row of the key.

    Equal times go to the smallest version and tie-break values.  Of the rows of a key and
    millisecond one is left before any key is gathered, so copies of a hot key are dropped
    where they are read; rows without a time are left out.
    """
    ms = F.unix_millis(time)
    one = _one_per_key(
        df.where(F.col(time).isNotNull()).withColumn("_ms", ms), [*keys, "_ms"],
        [F.col(c).asc_nulls_last() for c in (version, *tie_break)],
    )
    # a key is cut into time slices, each with the end of the slice before it as context,
    # so that no task sorts the whole history of a key
    slice_ms = SLICE_FACTOR * (idle_ms + 1)
    own = F.floor(F.col("_ms") / slice_ms)
    near_end = F.col("_ms") >= (own + 1) * slice_ms - idle_ms
    sliced = one.withColumn("_own", own).withColumn(
        "_slice", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    before = F.lag("_ms").over(Window.partitionBy(*keys, "_slice").orderBy("_ms"))
    gap = sliced.withColumn("_before", before).where("_slice = _own")
    first = F.col("_before").isNull() | (F.col("_ms") - F.col("_before") > idle_ms)
    return gap.where(first).drop("_ms", "_own", "_slice", "_before")
