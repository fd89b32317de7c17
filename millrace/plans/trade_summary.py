"""Windowed trade summaries: payments, orders, provinces, products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import codes
from millrace.functions.times import as_time
from millrace.operators import firsts
from millrace.operators.dedup import dedup_first, dedup_latest
from millrace.operators.lookups import lookup
from millrace.operators.user_windows import windows_with_first_visits
from millrace.operators.windows import stamped, tumble, tumble_distinct, with_event_time

MONEY = "decimal(18,4)"

#: Everything that can differ between two versions of a position; orders equal versions.
DETAIL_TIE_BREAK = (
    "sku_id", "sku_num", "order_price", "split_total_amount", "split_activity_amount",
    "split_coupon_amount",
)


def _latest(
    df: DataFrame, key: str, time: str, tie_break: Sequence[str], settle_ms: int | None, columns: Sequence[str]
) -> DataFrame:
    """``columns`` of the newest version of each key, with ``event_time`` from the text column ``time``.

    On streams the newest of those that arrive within 5 seconds by the clock; with
    ``settle_ms`` of those within so many milliseconds by event time, which is repeatable.
    """
    needed = dict.fromkeys((key, "row_op_ts", *tie_break, *columns))
    # what is not asked for is neither shuffled nor kept in state
    timed = df.withColumn("event_time", as_time(F.col(time))).select(*needed, "event_time")
    if not df.isStreaming:
        return dedup_latest(timed, [key], "row_op_ts", tie_break)
    from millrace.streaming import stateful

    if settle_ms is None:
        latest = stateful.keep_latest(timed, key, "row_op_ts", tie_break)
        return with_event_time(latest.where("event_time is not null"), "event_time")
    return stateful.settle_latest(timed, [key], "event_time", "row_op_ts", settle_ms, tie_break)


def _money(column: str):
    return F.coalesce(F.col(column).try_cast(MONEY), F.lit(0).cast(MONEY))


def payment_window(
    payments: DataFrame,
    size: str = codes.WINDOW_SIZE,
    settle_ms: int | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Users paying for the first time that day, and for the first time ever, per window.

    A stream may start with the users of an earlier table: see ``payment_history``.
    """
    tie_break = ("callback_time", "user_id")
    rows = _latest(payments, "order_detail_id", "callback_time", tie_break, settle_ms, ["user_id"]).select("user_id", "event_time")
    if payments.isStreaming:
        from millrace.streaming import stateful

        flags = stateful.visit_flags(rows, "user_id", "event_time", history=history)
        new = F.sum("new")
        time = "event_time"
    else:
        flags = firsts.with_visit_history(
            firsts.daily_visits(rows, ["user_id"], "event_time"), "user_id"
        )
        new = F.count_if(F.col("gap_days").isNull())
        time = "first_time"
    return stamped(
        tumble(
            flags, time, [F.count(F.lit(1)).alias("unique_users"), new.alias("new_users")], size
        )
    )


def payment_history(payments: DataFrame) -> DataFrame:
    """The last payment day of each user of a batch table, for the first start of a stream."""
    from millrace.streaming import stateful

    rows = _latest(payments, "order_detail_id", "callback_time", ("callback_time", "user_id"), None, ["user_id"])
    return stateful.last_visits(rows, "user_id", "event_time")


def order_window(
    details: DataFrame,
    size: str = codes.WINDOW_SIZE,
    tie_break: Sequence[str] = DETAIL_TIE_BREAK,
    settle_ms: int | None = None,
) -> DataFrame:
    """Ordering users and order amounts per window."""
    rows = _latest(
        details, "id", "create_time", tie_break, settle_ms,
        ["user_id", "split_activity_amount", "split_coupon_amount", "sku_num", "order_price"],
    ).select(
        "user_id", "event_time",
        _money("split_activity_amount").alias("activity"),
        _money("split_coupon_amount").alias("coupon"),
        (F.col("sku_num").try_cast("int") * F.col("order_price").try_cast(MONEY)).alias("original"),
    )
    amounts = {
        "activity_reduce": "activity", "coupon_reduce": "coupon", "original_total": "original",
    }
    if details.isStreaming:
        from millrace.streaming import stateful

        # amounts come along with the visits, so the versions of a position are settled once
        measures = stateful.visit_flags(rows, "user_id", "event_time", sums=list(amounts.values()))
        counted = tumble(
            measures, "event_time",
            [F.sum("unique").alias("unique_users"), F.sum("new").alias("new_users"),
             *[F.sum(c).alias(n) for n, c in amounts.items()]],
            size,
        )
    else:
        counted = windows_with_first_visits(
            rows, "user_id", "event_time", size,
            totals=[F.sum(c).alias(n) for n, c in amounts.items()],
        ).agg(
            F.count_if(F.col("is_visit")).alias("unique_users"),
            F.count_if(F.col("is_new")).alias("new_users"),
            *[F.sum(n).alias(n) for n in amounts],
        )
    return stamped(
        counted.select(
            "stt", "edt", "unique_users", "new_users",
            *[F.col(n).cast("double").alias(n) for n in amounts],
        )
    )


def province_order_window(
    details: DataFrame,
    provinces: DataFrame,
    size: str = codes.WINDOW_SIZE,
    tie_break: Sequence[str] = DETAIL_TIE_BREAK,
    settle_ms: int | None = None,
) -> DataFrame:
    """Orders and amounts per window and province, with the province name."""
    columns = ["province_id", "order_id", "split_total_amount"]
    rows = _latest(details, "id", "create_time", tie_break, settle_ms, columns).select(
        "province_id", "order_id", _money("split_total_amount").alias("amount"), "event_time"
    )
    counted = tumble_distinct(
        rows, "event_time", "order_id", "order_count", size, ["province_id"], {"order_amount": "amount"}
    ).withColumn("order_amount", F.col("order_amount").cast("double"))
    named = lookup(counted, provinces, "province_id", {"province_name": "name"})
    return stamped(
        named.select("stt", "edt", "province_id", "province_name", "order_count", "order_amount")
    )


def with_product_names(
    summary: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
) -> DataFrame:
    """Names of spu, trademark and the three category levels; misses stay null."""
    named = lookup(summary, spu, "spu_id", {"spu_name": "spu_name"})
    named = lookup(named, trademark, "trademark_id", {"trademark_name": "tm_name"})
    named = lookup(
        named, category3, "category3_id",
        {"category3_name": "name", "category2_id": "category2_id"},
    )
    named = lookup(
        named, category2, "category2_id",
        {"category2_name": "name", "category1_id": "category1_id"},
    )
    return lookup(named, category1, "category1_id", {"category1_name": "name"})


def user_spu_order_window(
    details: DataFrame,
    sku: DataFrame,
    spu: DataFrame,
    trademark: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
    size: str = codes.WINDOW_SIZE,
    tie_break: Sequence[str] = DETAIL_TIE_BREAK,
    idle_ms: int = codes.DETAIL_IDLE_MS,
) -> DataFrame:
    """Orders and amounts per window, user and product group.

    The ids come from the sku before the aggregate; the names are added after
    it, to far fewer rows.  On streams the first row of a position counts, and again
    after ``idle_ms`` without one.
    """
    needed = dict.fromkeys(("id", "row_op_ts", *tie_break, "user_id", "order_id", "sku_id", "split_total_amount"))
    rows = details.withColumn("event_time", as_time(F.col("create_time"))).select(*needed, "event_time")
    if details.isStreaming:
        from millrace.streaming import stateful

        rows = stateful.keep_first(rows, ["id"], "event_time", "row_op_ts", idle_ms, tie_break)
    else:
        rows = dedup_first(rows, ["id"], "row_op_ts", tie_break)
    rows = rows.select(
        "user_id", "order_id", "sku_id", _money("split_total_amount").alias("amount"), "event_time"
    )
    rows = lookup(
        rows, sku, "sku_id",
        {"spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"},
    )
    counted = tumble_distinct(
        rows, "event_time", "order_id", "order_count", size,
        ["user_id", "spu_id", "trademark_id", "category3_id"], {"order_amount": "amount"},
    ).withColumn("order_amount", F.col("order_amount").cast("double"))
    named = with_product_names(counted, spu, trademark, category3, category2, category1)
    return stamped(
        named.select(
            "stt", "edt", "trademark_id", "trademark_name", "category1_id", "category1_name",
            "category2_id", "category2_name", "category3_id", "category3_name", "user_id",
            "spu_id", "spu_name", "order_count", "order_amount",
        )
    )
