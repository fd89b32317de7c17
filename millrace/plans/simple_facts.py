"""Facts taken from one table: coupons, favourites, comments, registrations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace import codes
from millrace.functions.times import date_id
from millrace.operators.cdc import changes, data, fields, moved
from millrace.operators.lookups import dictionary_name


def coupon_get(cdc: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Coupons handed out."""
    return changes(cdc, "coupon_use", (codes.INSERT,), database).select(
        *fields("id", "coupon_id", "user_id"),
        date_id(data("get_time")).alias("date_id"),
        *fields("get_time"),
    )


def coupon_order(cdc: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Coupons put into an order: their status moved from received to in use."""
    return (
        changes(cdc, "coupon_use", (codes.UPDATE,), database)
        .where(moved("coupon_status", codes.COUPON_GOT, codes.COUPON_IN_ORDER))
        .select(
            *fields("id", "coupon_id", "user_id", "order_id"),
            date_id(data("using_time")).alias("date_id"),
            data("using_time").alias("order_time"),
        )
    )


def coupon_pay(cdc: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Coupons used up by a payment; every later update of such a record counts again."""
    return (
        changes(cdc, "coupon_use", (codes.UPDATE,), database)
        .where(data("used_time").isNotNull())
        .select(
            *fields("id", "coupon_id", "user_id", "order_id"),
            date_id(data("used_time")).alias("date_id"),
            data("used_time").alias("payment_time"),
        )
    )


def favor_add(cdc: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Goods marked as favourites."""
    return changes(cdc, "favor_info", (codes.INSERT,), database).select(
        *fields("id", "user_id", "sku_id"),
        date_id(data("create_time")).alias("date_id"),
        *fields("create_time"),
    )


def comment_add(
    cdc: DataFrame, dictionary: DataFrame, database: str = codes.DEFAULT_DATABASE
) -> DataFrame:
    """Comments with the name of their rating."""
    comments = changes(cdc, "comment_info", (codes.INSERT,), database).select(
        *fields("id", "user_id", "sku_id", "order_id"),
        date_id(data("create_time")).alias("date_id"),
        *fields("create_time"),
        data("appraise").alias("appraise_code"),
    )
    return dictionary_name(comments, dictionary, "appraise_code", "appraise_name")


def user_register(cdc: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Registrations."""
    return changes(cdc, "user_info", (codes.INSERT,), database).select(
        data("id").alias("user_id"),
        date_id(data("create_time")).alias("date_id"),
        *fields("create_time"),
    )
