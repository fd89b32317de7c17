"""Equi-joins of two change streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.codes import JOIN_RETENTION, WATERMARK
from millrace.operators.windows import with_event_time


def retained_join(
    left: DataFrame,
    right: DataFrame,
    on: Column,
    left_time: str,
    right_time: str,
    how: str = "inner",
    retention: str = JOIN_RETENTION,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Join on ``on``.  Streams also need the two event times to lie within
    ``retention`` of each other, which lets Spark drop old state; batch frames
    join without a bound.  A left join of streams emits the unmatched row once,
    when the watermark has passed the bound.

    ``left`` must carry its watermark already if it comes out of another join.
    """
    streaming = left.isStreaming or right.isStreaming
    if streaming:
        right = with_event_time(right, right_time, watermark)
        bound = F.expr(f"INTERVAL {retention}")
        on = (
            on
            & (F.col(right_time) >= F.col(left_time) - bound)
            & (F.col(right_time) <= F.col(left_time) + bound)
        )
    joined = left.join(right, on, how)
    if streaming:
        # a computed copy is a plain time: the next stateful step may see one event time only
        joined = joined.withColumn(right_time, F.timestamp_micros(F.unix_micros(right_time)))
    return joined
