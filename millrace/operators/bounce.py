"""Bounces: a page without a previous page that nothing follows in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slice length in multiples of ``within``; 1/32 of the rows are read by two slices.
SLICE_FACTOR = 32


def bounces(
    df: DataFrame,
    key: Column,
    time_ms: Column,
    previous_page: Column,
    within_ms: int,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Rows that open a visit and are followed, per key and in time order, by another
    opening row or by nothing for ``within_ms``.

    A row must look ahead by less than ``within_ms`` only.  So each key is cut
    into time slices, and the rows at the head of a slice are repeated as
    context at the end of the slice before.  A key with very many rows becomes
    many small groups, and no row needs its key's whole history.
    """
    slice_ms = within_ms * SLICE_FACTOR
    into_slice = F.pmod("_ms", F.lit(slice_ms))
    start = F.col("_ms") - into_slice
    own = F.struct(start.alias("start"), F.lit(False).alias("context"))
    before = F.struct((start - slice_ms).alias("start"), F.lit(True).alias("context"))
    sliced = (
        df.where(key.isNotNull() & time_ms.isNotNull())
        .withColumn("_key", key)
        .withColumn("_ms", time_ms)
        .withColumn("_opens", previous_page.isNull())
        .withColumn(
            "_slice",
            F.explode(F.when(into_slice < within_ms, F.array(own, before)).otherwise(F.array(own))),
        )
    )
    ahead = Window.partitionBy("_key", "_slice.start").orderBy("_ms", *tie_break)
    next_ms = F.lead("_ms").over(ahead)
    next_opens = F.lead("_opens").over(ahead)
    return (
        sliced.withColumn(
            "_bounced",
            F.col("_opens")
            & (next_ms.isNull() | (next_ms - F.col("_ms") >= within_ms) | next_opens),
        )
        .where(F.col("_bounced") & ~F.col("_slice.context"))
        .drop("_key", "_ms", "_opens", "_slice", "_bounced")
    )
