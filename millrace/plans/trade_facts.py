"""Trade facts: carts, orders, cancellations, refunds, payments.

Inputs are change envelopes; outputs are text columns, as the sinks store them.
All functions take batch or streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import codes
from millrace.operators.cdc import changed, changes, commit_time, data, fields, increase
from millrace.operators.interval_join import retained_join
from millrace.operators.lookups import dictionary_name
from millrace.operators.windows import with_event_time

ORDER_DETAIL_COLUMNS = (
    "id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time",
    "source_type", "source_id", "split_total_amount", "split_activity_amount",
    "split_coupon_amount",
)
ORDER_COLUMNS = (
    "consignee", "consignee_tel", "total_amount", "order_status", "user_id", "payment_way",
    "delivery_address", "order_comment", "out_trade_no", "trade_body", "operate_time",
    "expire_time", "process_status", "tracking_no", "parent_order_id", "province_id",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
    "feight_fee_reduce", "refundable_time",
)
#: What an order position looks like in every fact made of the wide table.
POSITION_COLUMNS = (
    "id", "order_id", "user_id", "sku_id", "sku_name", "sku_num", "order_price", "province_id",
    "activity_id", "activity_rule_id", "coupon_id", "source_id", "source_type_id",
    "source_type_name", "split_activity_amount", "split_coupon_amount", "split_total_amount",
)


def cart_add(cdc: DataFrame, dictionary: DataFrame, database: str = codes.DEFAULT_DATABASE) -> DataFrame:
    """Goods put into carts: new cart rows, and the increase where a quantity rose."""
    rows = changes(cdc, "cart_info", (codes.INSERT, codes.UPDATE), database).where(
        (F.col("type") == codes.INSERT) | (increase("sku_num") > 0)
    )
    added = rows.select(
        *fields("id", "user_id", "sku_id", "cart_price"),
        F.when(F.col("type") == codes.INSERT, data("sku_num"))
        .otherwise(increase("sku_num").cast("string"))
        .alias("sku_num"),
        *fields("sku_name", "is_checked", "create_time", "operate_time", "is_ordered", "order_time"),
        data("source_type").alias("source_type_id"),
        *fields("source_id"),
    )
    return dictionary_name(added, dictionary, "source_type_id", "source_type_name")


def order_wide(
    cdc: DataFrame,
    dictionary: DataFrame,
    database: str = codes.DEFAULT_DATABASE,
    retention: str = codes.JOIN_RETENTION,
    watermark: str = codes.WATERMARK,
) -> DataFrame:
    """Order positions with their order, activity and coupon; one row per position and
    version of the order.

    ``row_op_ts`` is the commit time of the newest record in the row, so replays
    give the same value.
    """
    detail = changes(cdc, "order_detail", (codes.INSERT,), database).select(
        *fields(*ORDER_DETAIL_COLUMNS), commit_time().alias("_detail_time")
    )
    order = changes(cdc, "order_info", (codes.INSERT, codes.UPDATE), database).select(
        data("id").alias("_order_key"), *fields(*ORDER_COLUMNS), "type", "old",
        commit_time().alias("_order_time"),
    )
    activity = changes(cdc, "order_detail_activity", (codes.INSERT,), database).select(
        data("order_detail_id").alias("_activity_key"),
        data("id").alias("order_detail_activity_id"),
        *fields("activity_id", "activity_rule_id"),
        commit_time().alias("_activity_time"),
    )
    coupon = changes(cdc, "order_detail_coupon", (codes.INSERT,), database).select(
        data("order_detail_id").alias("_coupon_key"),
        data("id").alias("order_detail_coupon_id"),
        *fields("coupon_id", "coupon_use_id"),
        commit_time().alias("_coupon_time"),
    )
    bounds = {"retention": retention, "watermark": watermark}
    named = dictionary_name(
        with_event_time(detail, "_detail_time", watermark), dictionary, "source_type", "source_type_name"
    )
    # the two left joins share the position id, so they come before the join on
    # the order: the positions are then shuffled twice instead of three times
    joined = retained_join(
        named, activity, F.col("id") == F.col("_activity_key"),
        "_detail_time", "_activity_time", "left", **bounds,
    )
    joined = retained_join(
        joined, coupon, F.col("id") == F.col("_coupon_key"),
        "_detail_time", "_coupon_time", "left", **bounds,
    )
    # one time instead of three is shuffled and kept in state
    joined = joined.withColumn("_newest", F.greatest("_detail_time", "_activity_time", "_coupon_time"))
    joined = retained_join(
        joined, order, F.col("order_id") == F.col("_order_key"),
        "_detail_time", "_order_time", **bounds,
    )
    return joined.select(
        *ORDER_DETAIL_COLUMNS, F.col("source_type").alias("source_type_id"), "source_type_name", *ORDER_COLUMNS,
        "order_detail_activity_id", "activity_id", "activity_rule_id",
        "order_detail_coupon_id", "coupon_id", "coupon_use_id", "type", "old",
        F.greatest("_newest", "_order_time").alias("row_op_ts"),
        *(["_detail_time"] if cdc.isStreaming else []),
    )


def order_detail(wide: DataFrame) -> DataFrame:
    """Positions of new orders."""
    return wide.where(F.col("type") == codes.INSERT).select(
        *POSITION_COLUMNS, "create_time", "row_op_ts"
    )


def order_cancel(wide: DataFrame) -> DataFrame:
    """Positions of orders that were cancelled by this change."""
    return wide.where(
        (F.col("type") == codes.UPDATE)
        & changed("order_status")
        & (F.col("order_status") == codes.ORDER_CANCELLED)
    ).select(*POSITION_COLUMNS, F.col("operate_time").alias("cancel_time"))


def _order_moved_to(cdc: DataFrame, status: str, database: str) -> DataFrame:
    return (
        changes(cdc, "order_info", (codes.UPDATE,), database)
        .where((data("order_status") == status) & changed("order_status"))
        .select(
            data("id").alias("_order_key"),
            data("user_id").alias("_order_user"),
            *fields("province_id"),
            commit_time().alias("_order_time"),
        )
    )


def order_refund(
    cdc: DataFrame,
    dictionary: DataFrame,
    database: str = codes.DEFAULT_DATABASE,
    retention: str = codes.JOIN_RETENTION,
    watermark: str = codes.WATERMARK,
) -> DataFrame:
    """Refund requests of orders that moved to the refund status."""
    request = changes(cdc, "order_refund_info", (codes.INSERT,), database).select(
        *fields(
            "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
            "refund_reason_type", "refund_reason_txt", "refund_status", "create_time",
        ),
        commit_time().alias("_refund_time"),
    )
    request = dictionary_name(request, dictionary, "refund_type", "type_dic_name")
    request = dictionary_name(request, dictionary, "refund_reason_type", "reason_dic_name")
    joined = retained_join(
        with_event_time(request, "_refund_time", watermark),
        _order_moved_to(cdc, codes.ORDER_REFUND_ASKED, database),
        F.col("order_id") == F.col("_order_key"),
        "_refund_time", "_order_time", retention=retention, watermark=watermark,
    )
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "refund_type", "type_dic_name",
        "refund_num", "refund_amount", "refund_reason_type", "reason_dic_name",
        "refund_reason_txt", "refund_status", "create_time",
    )


def pay_detail(
    cdc: DataFrame,
    details: DataFrame,
    dictionary: DataFrame,
    database: str = codes.DEFAULT_DATABASE,
    retention: str = codes.JOIN_RETENTION,
    watermark: str = codes.WATERMARK,
) -> DataFrame:
    """Positions of paid orders; ``details`` is the output of :func:`order_detail`.

    Any update of a paid payment record gives rows again.
    """
    payment = (
        changes(cdc, "payment_info", (codes.UPDATE,), database)
        .where(data("payment_status") == codes.PAYMENT_PAID)
        .select(
            data("order_id").alias("_payment_order"),
            data("payment_type").alias("payment_type_code"),
            *fields("callback_time"),
            commit_time().alias("_payment_time"),
        )
    )
    payment = dictionary_name(
        payment, dictionary, "payment_type_code", "payment_type_name"
    )
    joined = retained_join(
        with_event_time(details, "row_op_ts", watermark),
        payment,
        F.col("order_id") == F.col("_payment_order"),
        "row_op_ts", "_payment_time", retention=retention, watermark=watermark,
    )
    return joined.select(
        F.col("id").alias("order_detail_id"), "order_id", "user_id", "sku_id", "sku_name",
        "province_id", "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
        "payment_type_name", "callback_time", "source_id", "source_type_id", "source_type_name",
        "sku_num", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"), "row_op_ts",
    )


def refund_detail(
    cdc: DataFrame,
    dictionary: DataFrame,
    by_sku: bool = True,
    database: str = codes.DEFAULT_DATABASE,
    retention: str = codes.JOIN_RETENTION,
    watermark: str = codes.WATERMARK,
) -> DataFrame:
    """Refunds that were paid out, with the order and the refunded quantity.

    Refund payments and refund records meet on the order and the goods, a row per refund
    payment; ``by_sku=False`` pairs them on the order alone, so an order with several
    refunded goods gives each combination.
    """
    done = (data("refund_status") == codes.REFUND_DONE) & changed("refund_status")
    payment = changes(cdc, "refund_payment", (codes.UPDATE,), database).where(done).select(
        *fields(
            "id", "out_trade_no", "order_id", "sku_id", "payment_type", "trade_no",
            "total_amount", "subject", "refund_status", "create_time", "callback_time",
            "callback_content",
        ),
        commit_time().alias("_refund_time"),
    )
    payment = dictionary_name(payment, dictionary, "payment_type", "payment_name")
    refund = changes(cdc, "order_refund_info", (codes.UPDATE,), database).where(done).select(
        data("order_id").alias("_refund_order"),
        data("sku_id").alias("_refund_sku"),
        *fields("refund_num"),
        commit_time().alias("_info_time"),
    )
    bounds = {"retention": retention, "watermark": watermark}
    joined = retained_join(
        with_event_time(payment, "_refund_time", watermark),
        _order_moved_to(cdc, codes.ORDER_REFUNDED, database),
        F.col("order_id") == F.col("_order_key"),
        "_refund_time", "_order_time", **bounds,
    )
    on = F.col("order_id") == F.col("_refund_order")
    if by_sku:
        on = on & (F.col("sku_id") == F.col("_refund_sku"))
    joined = retained_join(joined, refund, on, "_refund_time", "_info_time", **bounds)
    return joined.select(
        "id", "out_trade_no", "order_id", "sku_id", "payment_type", "payment_name", "trade_no",
        "total_amount", "subject", "refund_status", "create_time", "callback_time",
        "callback_content", F.col("_order_user").alias("user_id"), "province_id", "refund_num",
    )
