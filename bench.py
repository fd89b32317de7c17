"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.registry import QUERIES

HEADLINE = [
    "log_dirty_split", "log_route_page", "log_explode_displays", "traffic_unique_visitor",
    "traffic_user_jump", "keyword_window", "traffic_dims_window", "page_uv_window",
    "user_login_window", "user_register_window", "cart_uu_window", "explode_tokens",
    "cdc_envelope", "dim_upsert_latest", "lookup_join_left", "trade_cart_add",
    "trade_order_wide", "trade_order_detail", "trade_order_cancel", "trade_order_refund",
    "trade_pay_detail", "trade_refund_detail", "coupon_order", "comment_add", "dedup_latest",
    "tumble_global", "window_distinct_count", "payment_window", "order_window",
    "province_order_window", "user_spu_order_window", "first_after_idle", "route_by_time", "as_of_join",
    "snapshot_then_changes", "trade_pay_detail_from_feed", "window_distinct_sketch",
    "traffic_unique_visitor_stream", "page_uv_window_stream", "user_login_window_stream",
    "window_distinct_count_stream", "trade_order_refund_stream", "sink_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one untimed query starts the executor threads and the compiler
    QUERIES["tumble_keyed"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        # every row and column is computed, nothing comes to the driver
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
