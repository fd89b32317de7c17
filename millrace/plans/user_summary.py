"""Windowed user summaries: logins, registrations, carts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import codes
from millrace.functions.times import as_time, millis_to_time
from millrace.operators import firsts
from millrace.operators.user_windows import windows_with_first_visits
from millrace.operators.windows import stamped, tumble, with_event_time


def user_login_window(
    page_log: DataFrame, size: str = codes.WINDOW_SIZE, gap_days: int = codes.RETURN_GAP_DAYS
) -> DataFrame:
    """Users logging in per window, and users back after more than ``gap_days`` days.

    A login is a page without a previous page, or one reached from the login
    page.  Windows that hold pages of known users but no first login count zero.
    """
    last_page = F.col("page.last_page_id")
    rows = page_log.where(F.col("common.uid").isNotNull()).select(
        F.col("common.uid").alias("user_id"),
        millis_to_time(F.col("ts")).alias("event_time"),
        (last_page.isNull() | (last_page == codes.PAGE_LOGIN)).alias("is_login"),
    )
    if page_log.isStreaming:
        from millrace.streaming import stateful

        # every page of a known user opens its window; only first logins need state
        rows = with_event_time(rows.where(F.col("event_time").isNotNull()), "event_time")
        measures = rows.select(
            "event_time", F.lit(0).alias("unique"), F.lit(None).cast("int").alias("gap_days")
        ).unionByName(
            stateful.visit_flags(rows, "user_id", "event_time", visit=F.col("is_login"))
            .select("event_time", "unique", "gap_days")
        )
        counted = tumble(
            measures,
            "event_time",
            [F.count_if(F.col("gap_days") > gap_days).alias("back_ct"),
             F.sum("unique").alias("uu_ct")],
            size,
        )
    else:
        counted = windows_with_first_visits(
            rows, "user_id", "event_time", size, visit=F.col("is_login")
        ).agg(
            F.count_if(F.col("gap_days") > gap_days).alias("back_ct"),
            F.count_if(F.col("is_visit")).alias("uu_ct"),
        )
    return stamped(counted.select("stt", "edt", "back_ct", "uu_ct"))


def user_register_window(registrations: DataFrame, size: str = codes.WINDOW_SIZE) -> DataFrame:
    """Registrations per window."""
    rows = registrations.select(as_time(F.col("create_time")).alias("event_time"))
    return stamped(
        tumble(
            with_event_time(rows, "event_time"), "event_time",
            [F.count(F.lit(1)).alias("register_ct")], size,
        )
    )


def cart_uu_window(cart_rows: DataFrame, size: str = codes.WINDOW_SIZE) -> DataFrame:
    """Users adding to a cart for the first time that day, per window."""
    rows = cart_rows.select(
        "user_id",
        as_time(F.coalesce("operate_time", "create_time")).alias("event_time"),
    )
    if cart_rows.isStreaming:
        from millrace.streaming import stateful

        visits = stateful.daily_visits(rows, ["user_id"], "event_time")
    else:
        visits = firsts.daily_visits(rows, ["user_id"], "event_time")
    return stamped(
        tumble(visits, "first_time", [F.count(F.lit(1)).alias("cart_add_uu_ct")], size)
    )
