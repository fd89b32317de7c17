"""Tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.codes import WATERMARK, WINDOW_SIZE
from millrace.functions.times import wall_clock_millis, ymd_hms


def with_event_time(df: DataFrame, column: str, delay: str = WATERMARK) -> DataFrame:
    """Declare the watermark on streams; batch frames pass through unchanged."""
    return df.withWatermark(column, delay) if df.isStreaming else df


def tumble(
    df: DataFrame,
    time: str | Column,
    aggs: Sequence[Column],
    size: str = WINDOW_SIZE,
    keys: Sequence[str] = (),
) -> DataFrame:
    """``stt, edt, <keys>, <aggs>`` per tumbling window and key.

    One ``groupBy``: each task pre-aggregates before the shuffle, so neither a
    hot key nor a hot window sends its rows to one task.
    """
    grouped = df.groupBy(F.window(time, size).alias("_window"), *keys).agg(*aggs)
    return grouped.select(
        ymd_hms(F.col("_window.start")).alias("stt"),
        ymd_hms(F.col("_window.end")).alias("edt"),
        *[c for c in grouped.columns if c != "_window"],
    )


def tumble_distinct(
    df: DataFrame,
    time: str,
    column: str,
    name: str,
    size: str = WINDOW_SIZE,
    keys: Sequence[str] = (),
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """``stt, edt, <keys>, name, <sums>``: exact number of distinct values per window and key.

    ``sums`` are further totals, as ``{output name: column}``.  Two aggregates after each
    other, first per value: a hot group is spread over its values, in batch by Spark's own
    plan for ``count(distinct)``, on streams by two chained ones, so that no state holds a
    group's values as a set.
    """
    totals = sums or {}
    if not df.isStreaming:
        aggs = [F.count_distinct(F.col(column)).alias(name), *[F.sum(c).alias(n) for n, c in totals.items()]]
        return tumble(df, time, aggs, size, keys)
    each = df.groupBy(F.window(time, size).alias("_each"), *keys, column).agg(
        *([F.sum(c).alias(n) for n, c in totals.items()] or [F.count(F.lit(1)).alias("_n")])
    )
    grouped = each.groupBy(F.window("_each", size).alias("_window"), *keys).agg(
        F.count(column).alias(name), *[F.sum(n).alias(n) for n in totals]
    )
    return grouped.select(
        ymd_hms(F.col("_window.start")).alias("stt"), ymd_hms(F.col("_window.end")).alias("edt"),
        *keys, name, *totals,
    )


def distinct_sketches(
    df: DataFrame, time: str, column: str, size: str = WINDOW_SIZE, keys: Sequence[str] = (), lg_k: int = 12
) -> DataFrame:
    """``slot_time, <keys>, sketch``: a mergeable sketch of the values of each slot, without nulls.

    A sketch takes some kilobytes at most, however many values it has seen, so slots of ten
    seconds can be kept and rolled up to any longer window without reading the rows again.
    ``column`` is a whole number or text.
    """
    grouped = df.groupBy(F.window(time, size).alias("_slot"), *keys).agg(
        F.hll_sketch_agg(F.col(column), F.lit(lg_k)).alias("sketch")
    )
    return grouped.select(F.col("_slot.start").alias("slot_time"), *keys, "sketch")


def roll_up_distinct(sketches: DataFrame, name: str, size: str, keys: Sequence[str] = ()) -> DataFrame:
    """``stt, edt, <keys>, name``: estimated distinct values per longer window, from sketches of its slots.

    The standard error is about ``1.04 / sqrt(2 ** lg_k)``, 1.6 % for the default; small numbers
    are nearly exact.  ``size`` is a multiple of the slots' size.
    """
    return tumble(sketches, "slot_time", [F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name)], size, keys)


def stamped(df: DataFrame) -> DataFrame:
    """Append the wall clock of the write as ``ts`` (milliseconds)."""
    return df.withColumn("ts", wall_clock_millis())
