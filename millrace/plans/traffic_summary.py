"""Windowed traffic summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import codes
from millrace.functions.times import millis_to_time
from millrace.operators import firsts
from millrace.operators.windows import stamped, tumble, with_event_time
from millrace.operators.words import explode_words

DIMS = ("vc", "ch", "ar", "is_new")
MEASURES = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")


def keyword_window(page_log: DataFrame, size: str = codes.WINDOW_SIZE) -> DataFrame:
    """Searched words per window."""
    searched = page_log.where(
        (F.col("page.last_page_id") == codes.PAGE_SEARCH)
        & (F.col("page.item_type") == codes.ITEM_KEYWORD)
        & F.col("page.item").isNotNull()
    ).select(F.col("page.item").alias("item"), millis_to_time(F.col("ts")).alias("rt"))
    word_rows = explode_words(with_event_time(searched, "rt"), "item", "keyword")
    counted = tumble(
        word_rows, "rt", [F.count(F.lit(1)).alias("keyword_count")], size, ["keyword"]
    )
    return stamped(
        counted.select(
            "stt", "edt", F.lit(codes.PAGE_SEARCH).alias("source"), "keyword", "keyword_count"
        )
    )


def _measures(rows: DataFrame, **given) -> DataFrame:
    values = {m: given.get(m, F.lit(0)).cast("bigint") for m in MEASURES}
    measured = rows.select(
        *[F.col(f"common.{d}").alias(d) for d in DIMS],
        *[v.alias(m) for m, v in values.items()],
        millis_to_time(F.col("ts")).alias("event_time"),
    )
    return with_event_time(measured, "event_time", codes.TRAFFIC_WATERMARK)


def traffic_measures(page_log: DataFrame, visitors: DataFrame, jumps: DataFrame) -> DataFrame:
    """One measure row per unique visitor, bounce and page view."""
    one = F.lit(1)
    page_views = _measures(
        page_log,
        pv_ct=one,
        sv_ct=F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("page.during_time"), F.lit(0)),
    )
    return (
        _measures(visitors, uv_ct=one)
        .unionByName(_measures(jumps, uj_ct=one))
        .unionByName(page_views)
    )


def traffic_dims_window(
    page_log: DataFrame, visitors: DataFrame, jumps: DataFrame, size: str = codes.WINDOW_SIZE
) -> DataFrame:
    """Traffic measures per window, version, channel, area and newness."""
    measures = traffic_measures(page_log, visitors, jumps)
    return stamped(
        tumble(measures, "event_time", [F.sum(m).alias(m) for m in MEASURES], size, DIMS)
    )


def page_uv_window(page_log: DataFrame, size: str = codes.WINDOW_SIZE) -> DataFrame:
    """Daily-first visitors of the home page and of the goods page per window."""
    viewed = page_log.where(
        F.col("page.page_id").isin(codes.PAGE_HOME, codes.PAGE_GOOD_DETAIL)
    ).select(
        F.col("common.mid").alias("mid"),
        F.col("page.page_id").alias("page_id"),
        millis_to_time(F.col("ts")).alias("event_time"),
    )
    if page_log.isStreaming:
        from millrace.streaming import stateful

        visits = stateful.daily_visits(viewed, ["mid", "page_id"], "event_time")
    else:
        visits = firsts.daily_visits(viewed, ["mid", "page_id"], "event_time")

    def seen(page: str, name: str):
        return F.count_if(F.col("page_id") == page).alias(name)

    return stamped(
        tumble(
            visits,
            "first_time",
            [
                seen(codes.PAGE_HOME, "home_uv_ct"),
                seen(codes.PAGE_GOOD_DETAIL, "good_detail_uv_ct"),
            ],
            size,
        )
    )
