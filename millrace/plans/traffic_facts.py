"""Traffic facts from the page log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.codes import BOUNCE_WITHIN_MS
from millrace.functions.times import millis_to_time
from millrace.operators import bounce, firsts

def unique_visitors(page_log: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first page of each device and day."""
    if page_log.isStreaming:
        from millrace.streaming import stateful

        return stateful.unique_visitors(page_log, tie_break)
    return firsts.daily_first(
        page_log, F.col("common.mid"), millis_to_time(F.col("ts")), tie_break
    )


def user_jumps(
    page_log: DataFrame, within_ms: int = BOUNCE_WITHIN_MS, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Entry pages that the device left again without a further page in time."""
    if page_log.isStreaming:
        from millrace.streaming import stateful

        return stateful.user_jumps(page_log, within_ms, tie_break)
    return bounce.bounces(
        page_log, F.col("common.mid"), F.col("ts"), F.col("page.last_page_id"), within_ms, tie_break
    )
