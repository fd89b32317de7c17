"""Every registered query: a job of the library over the whole sample tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.codes import DEFAULT_DATABASE
from millrace.functions.times import millis_to_time, ymd_hms
from millrace.operators import cdc, firsts, logs, routing, windows
from millrace.operators.as_of import as_of_join
from millrace.operators.dedup import dedup_first, dedup_latest, first_after_idle
from millrace.operators.lookups import ExpiringTable, dictionary_name, lookup
from millrace.operators.words import explode_words
from millrace.plans import simple_facts, trade_facts, trade_summary, traffic_facts
from millrace.plans import traffic_summary, user_summary
from millrace.session import prepare, shared_dir
from millrace.sources import readers, sample
from millrace.streaming import jobs, sinks, stateful

Query = Callable[[SparkSession, str], DataFrame]
SIX_HOURS_MS = 21_600_000
ID = ("event_id",)

QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; the session gets the runtime settings first."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[name] = run
        return build

    return add


def windowed(name: str, build) -> None:
    """Register a summary with its 10-second windows and with windows of a day."""
    query(name)(lambda spark, d: build(spark, d, "10 seconds").drop("ts"))
    query(f"{name}_1d")(lambda spark, d: build(spark, d, "1 day").drop("ts"))


# --- logs -------------------------------------------------------------------


def _parsed(spark, d):
    return logs.parse_logs(sample.raw_logs(spark, d))


@query("log_dirty_split")
def _(spark, d):
    """Every record: whether it is broken and how, and what typed fields were recovered."""
    parsed = _parsed(spark, d)
    broken, clean = F.col(cdc.CORRUPT).isNotNull(), F.col(cdc.CORRUPT).isNull()
    return parsed.select(
        "event_id", broken.alias("is_dirty"),
        F.when(F.col(cdc.CORRUPT).endswith("} xyz"), "more text").when(broken, "cut").alias("fault"),
        F.when(clean, F.col("ts")).alias("ts"), F.when(clean, F.col("page.during_time")).alias("during_time"),
    )


@query("log_route_error")
def _(spark, d):
    return logs.errors(logs.clean(_parsed(spark, d))).withColumn("common", F.to_json("common"))


@query("log_route_start")
def _(spark, d):
    return logs.starts(logs.clean(_parsed(spark, d))).withColumn("common", F.to_json("common"))


@query("log_route_page")
def _(spark, d):
    return logs.pages(logs.clean(_parsed(spark, d))).select(
        "event_id",
        *[f"common.{c}" for c in ("mid", "uid", "vc", "ch", "ar", "is_new")],
        *[f"page.{c}" for c in ("page_id", "last_page_id", "item", "item_type", "during_time")],
        "ts",
    )


@query("log_explode_displays")
def _(spark, d):
    return logs.displays(logs.clean(_parsed(spark, d)))


@query("log_explode_displays_min2")
def _(spark, d):
    return logs.displays(logs.clean(_parsed(spark, d)), min_size=2)


@query("log_explode_actions")
def _(spark, d):
    return logs.actions(logs.clean(_parsed(spark, d)))


# --- traffic ----------------------------------------------------------------


def _page_fields(pages, *more):
    return pages.select(
        "event_id", "common.mid", "page.page_id", "page.last_page_id", "ts",
        *[f"common.{c}" for c in more],
    )


@query("daily_first")
def _(spark, d):
    return _page_fields(
        firsts.daily_first(
            sample.page_log(spark, d), F.col("common.mid"), millis_to_time(F.col("ts")), ID
        )
    )


@query("first_ever")
def _(spark, d):
    return _page_fields(
        firsts.first_ever(
            sample.page_log(spark, d), F.col("common.uid"), millis_to_time(F.col("ts")), ID
        )
    )


@query("traffic_unique_visitor")
def _(spark, d):
    return _page_fields(
        traffic_facts.unique_visitors(sample.page_log(spark, d), ID), "vc", "ch", "ar", "is_new"
    )


@query("traffic_user_jump")
def _(spark, d):
    return _page_fields(traffic_facts.user_jumps(sample.page_log(spark, d), SIX_HOURS_MS, ID))


@query("traffic_user_jump_10s")
def _(spark, d):
    return _page_fields(traffic_facts.user_jumps(sample.page_log(spark, d), tie_break=ID))


windowed(
    "keyword_window",
    lambda spark, d, size: traffic_summary.keyword_window(sample.page_log(spark, d, True), size),
)
windowed(
    "page_uv_window",
    lambda spark, d, size: traffic_summary.page_uv_window(sample.page_log(spark, d), size),
)


def _traffic_inputs(spark, d, within_ms):
    log = sample.page_log(spark, d)
    return (
        log,
        traffic_facts.unique_visitors(log, ID),
        traffic_facts.user_jumps(log, within_ms, ID),
    )


@query("union_measures")
def _(spark, d):
    measures = traffic_summary.traffic_measures(*_traffic_inputs(spark, d, SIX_HOURS_MS))
    return measures.groupBy(*traffic_summary.DIMS).agg(
        *[F.sum(m).alias(m) for m in traffic_summary.MEASURES]
    )


@query("traffic_dims_window")
def _(spark, d):
    return traffic_summary.traffic_dims_window(*_traffic_inputs(spark, d, 10_000)).drop("ts")


@query("traffic_dims_window_1d")
def _(spark, d):
    return traffic_summary.traffic_dims_window(
        *_traffic_inputs(spark, d, SIX_HOURS_MS), size="1 day"
    ).drop("ts")


@query("explode_tokens")
def _(spark, d):
    docs = sample.table(spark, d, "documents").select("text")
    return explode_words(docs, "text").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --- users ------------------------------------------------------------------

query("user_login_window")(
    lambda spark, d: user_summary.user_login_window(sample.page_log(spark, d)).drop("ts")
)
query("user_login_window_1d")(
    lambda spark, d: user_summary.user_login_window(
        sample.page_log(spark, d), "1 day", gap_days=2
    ).drop("ts")
)
windowed(
    "user_register_window",
    lambda spark, d, size: user_summary.user_register_window(
        simple_facts.user_register(sample.change_records(spark, d, "user_info")), size
    ),
)


def _cart_add(spark, d):
    return trade_facts.cart_add(
        sample.change_records(spark, d, "cart_info"), sample.dictionary(spark)
    )


windowed(
    "cart_uu_window",
    lambda spark, d, size: user_summary.cart_uu_window(_cart_add(spark, d), size),
)

# --- change records ---------------------------------------------------------


def _as_text(records):
    return records.select(F.to_json(F.struct("*")).alias("value"))


@query("cdc_envelope")
def _(spark, d):
    text = _as_text(sample.change_records(spark, d, "cart_info", "favor_info"))
    return (
        readers.change_records(text)
        .groupBy("table", "type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("xid").alias("xid_sum"),
            F.sum(cdc.data("user_id").cast("bigint")).alias("user_sum"),
            F.count(cdc.old("sku_num")).alias("with_old"),
        )
    )


@query("cdc_filter_map")
def _(spark, d):
    records = sample.change_records(spark, d)
    return cdc.changes(records, "favor_info", ("insert",)).select(
        *cdc.fields("id", "user_id", "sku_id", "create_time", "not_there")
    )


@query("cdc_changed_column")
def _(spark, d):
    records = sample.change_records(spark, d, "cart_info")
    return cdc.changes(records, "cart_info", ("update",)).where(cdc.changed("sku_num")).select(
        "xid", cdc.old("sku_num").alias("old_sku_num")
    )


def _routes(spark):
    return routing.current_routes(readers.route_changes(sample.route_change_text(spark)))


_DIM_TABLES = ("base_province", "sku_info", "customer_info", "supplier_info")


def _routed(spark, d):
    return routing.route_dimensions(
        sample.change_records(spark, d, *_DIM_TABLES), _routes(spark)
    )


@query("cdc_debezium_after")
def _(spark, d):
    # the routes in force and how many change records each of them takes
    changes = sample.change_records(spark, d, *_DIM_TABLES).groupBy("table").agg(
        F.count(F.lit(1)).alias("changes")
    )
    return (
        _routes(spark)
        .join(changes, F.col("source_table") == F.col("table"), "left")
        .select(
            "source_table", "sink_table", "sink_columns", "sink_pk",
            F.coalesce("changes", F.lit(0)).alias("changes"),
        )
    )


@query("dim_route_by_config")
def _(spark, d):
    return _routed(spark, d).select("sink_table", "type", "pk")


@query("dim_project_columns")
def _(spark, d):
    kept = F.array_join(F.array_sort(F.map_keys("data")), ",")
    return _routed(spark, d).select("sink_table", "pk", kept.alias("kept"))


@query("dim_upsert_latest")
def _(spark, d):
    latest = routing.latest_dimensions(_routed(spark, d))
    return routing.dimension_table(
        latest, "dim_sku_info", ["id", "sku_name", "tm_id", "category3_id", "price"]
    )


@query("lookup_join_inner")
def _(spark, d):
    named = dictionary_name(
        sample.positions_raw(spark, d), sample.dictionary(spark),
        "source_type", "source_type_name",
    )
    return named.groupBy("source_type_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("split_total_amount").cast("double").alias("amount")
    )


@query("lookup_join_left")
def _(spark, d):
    rows = sample.table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_partkey").cast("string").alias("sku_id"),
    )
    grouped = lookup(rows, sample.sku(spark, d), "sku_id", {"spu_id": "spu_id"})
    named = lookup(grouped, sample.spu(spark, d), "spu_id", {"spu_name": "spu_name"})
    return named.select("order_id", "line", "spu_name")


# --- facts ------------------------------------------------------------------

query("trade_cart_add")(_cart_add)


def _wide(spark, d):
    records = sample.change_records(
        spark, d, "order_info", "order_detail", "order_detail_activity", "order_detail_coupon"
    )
    return trade_facts.order_wide(records, sample.dictionary(spark))


_ALWAYS_NULL = (
    "consignee", "consignee_tel", "payment_way", "delivery_address", "order_comment",
    "out_trade_no", "trade_body", "expire_time", "process_status", "tracking_no",
    "parent_order_id", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "feight_fee_reduce", "refundable_time",
)


def _shown_wide(wide):
    return (
        wide.withColumn("old_status", cdc.old("order_status"))
        .withColumn("row_op_ts", ymd_hms(F.col("row_op_ts")))
        .drop("old", *_ALWAYS_NULL)
    )


@query("trade_order_wide")
def _(spark, d):
    return _shown_wide(_wide(spark, d))


@query("trade_order_detail")
def _(spark, d):
    return trade_facts.order_detail(_wide(spark, d)).withColumn(
        "row_op_ts", ymd_hms(F.col("row_op_ts"))
    )


@query("trade_order_cancel")
def _(spark, d):
    return trade_facts.order_cancel(_wide(spark, d))


@query("trade_order_refund")
def _(spark, d):
    records = sample.change_records(spark, d, "order_info", "order_refund_info")
    return trade_facts.order_refund(records, sample.dictionary(spark))


@query("trade_pay_detail")
def _(spark, d):
    return trade_facts.pay_detail(
        sample.change_records(spark, d, "payment_info"),
        trade_facts.order_detail(_wide(spark, d)),
        sample.dictionary(spark),
    ).withColumn("row_op_ts", ymd_hms(F.col("row_op_ts")))


def _refund_detail(spark, d, by_sku):
    records = sample.change_records(
        spark, d, "order_info", "order_refund_info", "refund_payment"
    )
    return trade_facts.refund_detail(records, sample.dictionary(spark), by_sku)


query("trade_refund_detail")(lambda spark, d: _refund_detail(spark, d, False))
query("trade_refund_detail_by_sku")(lambda spark, d: _refund_detail(spark, d, True))


def _simple(name, build, table, with_dictionary=False):
    def run(spark, d):
        records = sample.change_records(spark, d, table)
        return build(records, sample.dictionary(spark)) if with_dictionary else build(records)

    query(name)(run)


_simple("coupon_get", simple_facts.coupon_get, "coupon_use")
_simple("coupon_order", simple_facts.coupon_order, "coupon_use")
_simple("coupon_pay", simple_facts.coupon_pay, "coupon_use")
_simple("favor_add", simple_facts.favor_add, "favor_info")
_simple("comment_add", simple_facts.comment_add, "comment_info", True)
_simple("user_register", simple_facts.user_register, "user_info")

# --- keyed state and windows ------------------------------------------------

_DEDUP_COLUMNS = (
    "id", "order_id", "sku_id", "sku_num", "order_price", "split_total_amount",
)


def _dedup(keep):
    def run(spark, d):
        rows = sample.order_detail_rows(spark, d)
        kept = keep(rows, ["id"], "row_op_ts", trade_summary.DETAIL_TIE_BREAK)
        return kept.select(*_DEDUP_COLUMNS, ymd_hms(F.col("row_op_ts")).alias("row_op_ts"))

    return run


query("dedup_latest")(_dedup(dedup_latest))
query("dedup_first")(_dedup(dedup_first))


def _event_sums():
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").cast("decimal(16,2)")).cast("double").alias("value_sum"),
    ]


@query("tumble_global")
def _(spark, d):
    return windows.tumble(sample.events(spark, d), "ts", _event_sums())


@query("tumble_keyed")
def _(spark, d):
    return windows.tumble(
        sample.events(spark, d), "ts", _event_sums(), "1 day", ["event_type"]
    )


@query("window_distinct_count")
def _(spark, d):
    return windows.tumble_distinct(sample.events(spark, d), "ts", "user_id", "users", "1 day", ["event_type"])


@query("window_distinct_sketch")
def _(spark, d):
    """Users per day from sketches of ten-second slots: the exact number, and whether the estimate is near it."""
    events = sample.events(spark, d)
    sketches = windows.distinct_sketches(events, "ts", "user_id", keys=["event_type"])
    estimated = windows.roll_up_distinct(sketches, "estimate", "1 day", ["event_type"])
    exact = windows.tumble_distinct(events, "ts", "user_id", "users", "1 day", ["event_type"])
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), 0.06 * F.col("users"))
    return exact.join(estimated, ["stt", "edt", "event_type"]).select("stt", "edt", "event_type", "users", near.alias("near"))


windowed(
    "payment_window",
    lambda spark, d, size: trade_summary.payment_window(
        trade_facts.pay_detail(
            sample.change_records(spark, d, "payment_info"),
            sample.order_detail_rows(spark, d),
            sample.dictionary(spark),
        ),
        size,
    ),
)
windowed(
    "order_window",
    lambda spark, d, size: trade_summary.order_window(sample.order_detail_rows(spark, d), size),
)
windowed(
    "province_order_window",
    lambda spark, d, size: trade_summary.province_order_window(
        sample.order_detail_rows(spark, d), sample.provinces(spark, d), size
    ),
)
windowed(
    "user_spu_order_window",
    lambda spark, d, size: trade_summary.user_spu_order_window(
        sample.order_detail_rows(spark, d),
        *[f(spark, d) for f in (sample.sku, sample.spu, sample.trademark, sample.category3,
                                sample.category2, sample.category1)],
        size=size,
    ),
)

# --- streams ----------------------------------------------------------------
# The same jobs fed by a stream of the sample table, written by a checkpointed
# query and read back.


def _through_stream(spark, rows, sink=sinks.append_table):
    folder = shared_dir(spark, "stream")
    sink(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/out"


def _written(spark, rows):
    return spark.read.schema(rows.schema).parquet(_through_stream(spark, rows))


# Rows far in the future move every watermark past all others; their own windows and state
# stay open, so a stream gives what its batch form gives, down to the last row.

FUTURE_S = 4_102_444_800
#: Micro-batches before the one with the rows in the future, where state is kept row by row.
FEW = 2


def _from_json(spark, schema, *texts):
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def _pages_in_batches(spark, d, with_item=False):
    pages = sample.page_log(spark, d, with_item)
    last = [
        {"event_id": -1, "common": {"mid": "last", "uid": "last"}, "ts": FUTURE_S * 1000,
         "page": {"page_id": page, "last_page_id": before, "item": "last", "item_type": "keyword"}}
        for page, before in (("home", "search"), ("good_detail", None), ("home", "login"))
    ]
    return sample.in_batches(pages, "ts", FEW, last=_from_json(spark, pages.schema, *map(json.dumps, last)))


def streamed(name: str, build) -> None:
    """Register a job over a stream of several micro-batches; the result is read back."""
    query(name)(lambda spark, d: _written(spark, build(spark, d)))


@query("src_stream")
def _(spark, d):
    """Text records of a stream, parsed, appended to a table."""
    text = _as_text(
        sample.page_log(spark, sample.StreamDir.of(d, "events"), True).drop("event_id")
    )
    rows = readers.page_table(text).select(
        "common.mid", "page.page_id", "page.last_page_id", "page.item", "ts",
        ymd_hms(F.col("rt")).alias("rt"),
    )
    return spark.read.schema(rows.schema).parquet(_through_stream(spark, rows))


@query("sink_append")
def _(spark, d):
    """Cart facts appended as JSON text by a stream, read back."""
    rows = _cart_add(spark, sample.StreamDir.of(d, "events"))
    path = _through_stream(spark, rows, sinks.append_text)
    return readers.json_table(readers.text_files(spark, path), rows.schema)


@query("sink_upsert")
def _(spark, d):
    """Goods kept by key from a stream of change records."""
    changes = sample.change_records(spark, sample.StreamDir.of(d, "part"), "sku_info")
    folder = shared_dir(spark, "dims")
    jobs.load_dimensions(
        changes, lambda: _routes(spark), f"{folder}/table", f"{folder}/checkpoint"
    ).awaitTermination()
    latest = jobs.dimension_store(f"{folder}/table").read(spark)
    return routing.dimension_table(
        latest, "dim_sku_info", ["id", "sku_name", "tm_id", "category3_id", "price"]
    )


@query("log_route_stream")
def _(spark, d):
    """All outputs of the log router, written by one stream; rows per output."""
    parsed = logs.parse_logs(sample.raw_logs(spark, sample.StreamDir.of(d, "events")))
    folder = shared_dir(spark, "logs")
    jobs.route_logs(parsed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    counts = [
        spark.read.parquet(f"{folder}/out/{name}").select(F.lit(name).alias("output"))
        for name in ("dirty", "error", "start", "display", "action", "page")
    ]
    union = counts[0]
    for c in counts[1:]:
        union = union.unionByName(c)
    return union.groupBy("output").agg(F.count(F.lit(1)).alias("n"))


streamed(
    "traffic_unique_visitor_stream",
    lambda spark, d: _page_fields(
        traffic_facts.unique_visitors(_pages_in_batches(spark, d), ID), "vc", "ch", "ar", "is_new"
    ),
)
streamed(
    "traffic_user_jump_stream",
    lambda spark, d: _page_fields(traffic_facts.user_jumps(_pages_in_batches(spark, d), SIX_HOURS_MS, ID)),
)
streamed(
    "keyword_window_stream",
    lambda spark, d: traffic_summary.keyword_window(_pages_in_batches(spark, d, True)).drop("ts"),
)
streamed(
    "page_uv_window_stream",
    lambda spark, d: traffic_summary.page_uv_window(_pages_in_batches(spark, d)).drop("ts"),
)
streamed(
    "user_login_window_stream",
    lambda spark, d: user_summary.user_login_window(_pages_in_batches(spark, d), "1 day", gap_days=2).drop("ts"),
)


@query("cart_uu_window_stream")
def _(spark, d):
    records = sample.change_records(spark, d, "cart_info")
    last = {"database": DEFAULT_DATABASE, "table": "cart_info", "type": "insert", "ts": FUTURE_S, "xid": 0,
            "data": {"id": "last", "user_id": "last", "sku_num": "1", "source_type": "2401",
                     "create_time": "2100-01-01 00:00:00"}}
    stream = sample.in_batches(
        records, "unix_seconds(CAST(coalesce(data['operate_time'], data['create_time']) AS TIMESTAMP))",
        FEW, last=_from_json(spark, records.schema, json.dumps(last)),
    )
    carts = trade_facts.cart_add(stream, sample.dictionary(spark))
    return _written(spark, user_summary.cart_uu_window(carts).drop("ts"))


@query("window_distinct_count_stream")
def _(spark, d):
    events = sample.events(spark, d)
    last = _from_json(spark, events.schema, json.dumps({"event_id": -1, "event_type": "last", "ts": "2100-01-01T00:00:00Z"}))
    stream = windows.with_event_time(sample.in_batches(events, "unix_micros(ts)", last=last), "ts")
    return _written(spark, windows.tumble_distinct(stream, "ts", "user_id", "users", "1 day", ["event_type"]))


@query("traffic_dims_window_stream")
def _(spark, d):
    """Visitors and jumps are tables of their own, read as streams beside the log."""
    log = sample.page_log(spark, d)
    parts = [
        _pages_in_batches(spark, d),
        *(
            sample.in_batches(rows, "ts", FEW, last=_from_json(spark, rows.schema, json.dumps(
                {"event_id": -1, "common": {"mid": "last"}, "page": {"page_id": "home"}, "ts": FUTURE_S * 1000})))
            for rows in (traffic_facts.unique_visitors(log, ID), traffic_facts.user_jumps(log, 10_000, ID))
        ),
    ]
    return _written(spark, traffic_summary.traffic_dims_window(*parts).drop("ts"))


# Details and payments in the order of their event time.  Versions of a position lie years
# apart in the sample, so these queries wait for longer than the whole span of the tables.

WAIT_MS = 10_000 * 86_400_000


def _details_in_batches(spark, d, time="create_time"):
    details = sample.order_detail_rows(spark, d)
    last = {"id": "last", "order_id": "last", "user_id": "last", "sku_id": "last", "create_time": "2100-01-01 00:00:00",
            "row_op_ts": "2100-01-01T00:00:00Z"}
    return sample.in_batches(
        details, f"unix_seconds(CAST({time} AS TIMESTAMP))", FEW, last=_from_json(spark, details.schema, json.dumps(last))
    )


#: What versions are told apart by and what is shown of them; the rest need not be kept in state.
_VERSION_COLUMNS = tuple(dict.fromkeys((*_DEDUP_COLUMNS, *trade_summary.DETAIL_TIE_BREAK, "row_op_ts")))


@query("dedup_first_stream")
def _(spark, d):
    """The first version of each position, kept in state until the watermark has passed it."""
    kept = stateful.keep_first(
        _details_in_batches(spark, d, "row_op_ts").select(*_VERSION_COLUMNS), ["id"], "row_op_ts", "row_op_ts", WAIT_MS, trade_summary.DETAIL_TIE_BREAK
    )
    return _written(spark, kept.select(*_DEDUP_COLUMNS, ymd_hms(F.col("row_op_ts")).alias("row_op_ts")))


@query("dedup_latest_stream")
def _(spark, d):
    kept = stateful.settle_latest(
        _details_in_batches(spark, d, "row_op_ts").select(*_VERSION_COLUMNS), ["id"], "row_op_ts", "row_op_ts", WAIT_MS, trade_summary.DETAIL_TIE_BREAK
    )
    return _written(spark, kept.select(*_DEDUP_COLUMNS, ymd_hms(F.col("row_op_ts")).alias("row_op_ts")))


_IDLE_MS = 30 * 86_400_000


@query("first_after_idle")
def _(spark, d):
    """The first row of each user, and again after thirty days without an order."""
    rows = sample.order_detail_rows(spark, d)
    kept = first_after_idle(rows, ["user_id"], "row_op_ts", "row_op_ts", _IDLE_MS, ("id", *trade_summary.DETAIL_TIE_BREAK))
    return kept.select("user_id", *_DEDUP_COLUMNS, ymd_hms(F.col("row_op_ts")).alias("row_op_ts"))


@query("first_after_idle_stream")
def _(spark, d):
    kept = stateful.keep_first(
        _details_in_batches(spark, d, "row_op_ts").select("user_id", *_VERSION_COLUMNS), ["user_id"], "row_op_ts", "row_op_ts", _IDLE_MS,
        ("id", *trade_summary.DETAIL_TIE_BREAK),
    )
    return _written(spark, kept.select("user_id", *_DEDUP_COLUMNS, ymd_hms(F.col("row_op_ts")).alias("row_op_ts")))


@query("payment_window_stream")
def _(spark, d):
    payments = trade_facts.pay_detail(
        sample.change_records(spark, d, "payment_info"), sample.order_detail_rows(spark, d), sample.dictionary(spark)
    )
    last = {"order_detail_id": "last", "user_id": "last", "callback_time": "2100-01-01 00:00:00", "row_op_ts": "2100-01-01T00:00:00Z"}
    stream = sample.in_batches(
        payments, "unix_seconds(CAST(callback_time AS TIMESTAMP))", FEW, last=_from_json(spark, payments.schema, json.dumps(last))
    )
    return _written(spark, trade_summary.payment_window(stream, settle_ms=WAIT_MS).drop("ts"))


streamed(
    "order_window_stream",
    lambda spark, d: trade_summary.order_window(_details_in_batches(spark, d), settle_ms=WAIT_MS).drop("ts"),
)
streamed(
    "province_order_window_stream",
    lambda spark, d: trade_summary.province_order_window(
        _details_in_batches(spark, d), sample.provinces(spark, d), settle_ms=WAIT_MS
    ).drop("ts"),
)
streamed(
    "user_spu_order_window_stream",
    lambda spark, d: trade_summary.user_spu_order_window(
        _details_in_batches(spark, d),
        *[f(spark, d) for f in (sample.sku, sample.spu, sample.trademark, sample.category3,
                                sample.category2, sample.category1)],
        idle_ms=WAIT_MS,
    ).drop("ts"),
)


# Joins of streams: change records in several micro-batches in the order of their commit
# time, and rows far in the future that move every watermark past all others.

#: How long these joins keep rows: positions of the sample are up to seven years away from their
#: order, so more than the whole span of the tables, and less than the rows in the future are away.
KEPT = "10000 days"


def _fed(spark, d, *tables, last=None):
    return sample.in_batches(sample.change_records(spark, d, *tables), "ts", last=last)


def _last_changes(spark, *tables):
    rows = spark.createDataFrame([(t,) for t in tables], "table string")
    return rows.selectExpr(
        f"'{DEFAULT_DATABASE}' AS database", "table", "'insert' AS type", "4102444800L AS ts", "0L AS xid",
        "map('id', 'last', 'order_id', 'last', 'order_detail_id', 'last', 'source_type', '2401') AS data",
        "CAST(NULL AS MAP<STRING, STRING>) AS old",
    )


_ORDER_TABLES = ("order_info", "order_detail", "order_detail_activity", "order_detail_coupon")


@query("trade_order_wide_stream")
def _(spark, d):
    stream = _fed(spark, d, *_ORDER_TABLES, last=_last_changes(spark, *_ORDER_TABLES))
    wide = _written(spark, trade_facts.order_wide(stream, sample.dictionary(spark), retention=KEPT))
    return _shown_wide(wide.where("id <> 'last'").drop("_detail_time"))


@query("trade_order_refund_stream")
def _(spark, d):
    stream = _fed(spark, d, "order_info", "order_refund_info")
    return _written(spark, trade_facts.order_refund(stream, sample.dictionary(spark)))


@query("trade_refund_detail_stream")
def _(spark, d):
    stream = _fed(spark, d, "order_info", "order_refund_info", "refund_payment")
    return _written(spark, trade_facts.refund_detail(stream, sample.dictionary(spark), by_sku=True))


@query("trade_pay_detail_stream")
def _(spark, d):
    """The details are a table of their own, read as a stream."""
    details = sample.in_batches(trade_facts.order_detail(_wide(spark, d)), "unix_seconds(row_op_ts)")
    paid = trade_facts.pay_detail(
        _fed(spark, d, "payment_info"), details, sample.dictionary(spark), retention=KEPT
    )
    return _written(spark, paid).withColumn("row_op_ts", ymd_hms(F.col("row_op_ts")))


# --- configuration by time, snapshots, logs of changes ---------------------------


def _timed_records(spark, d):
    return sample.change_records(spark, d, "cart_info", "favor_info")


def _shown_routes(routed):
    kept = F.array_join(F.array_sort(F.map_keys("data")), ",")
    return routed.select("sink_table", "type", "pk", "ts", "xid", kept.alias("kept"))


@query("route_by_time")
def _(spark, d):
    """Records by the configuration in force at their time, which changes half-way."""
    return _shown_routes(routing.route_by_time(_timed_records(spark, d), routing.route_versions(sample.route_history(spark))))


@query("route_by_time_stream")
def _(spark, d):
    """The same as a keyed table, from micro-batches that are not cut where the configuration changes."""
    folder = shared_dir(spark, "dims")
    stream = sample.in_batches(_timed_records(spark, d), "ts", batches=3)
    jobs.load_dimensions_by_time(
        stream, lambda: routing.route_versions(sample.route_history(spark)), f"{folder}/table", f"{folder}/checkpoint"
    ).awaitTermination()
    return _shown_routes(jobs.dimension_store(f"{folder}/table").read(spark))


@query("as_of_join")
def _(spark, d):
    """Each view with the newest purchase of its user at or before it."""
    events = sample.events(spark, d).withColumn("ms", F.unix_millis("ts"))
    bought = events.where("event_type = 'purchase'").select("user_id", "ms", F.struct("event_id").alias("bought"))
    views = events.where("event_type = 'view'").select("event_id", "user_id", "ms")
    return as_of_join(views, bought, ["user_id"], "ms", "bought").select(
        "event_id", F.col("bought.event_id").alias("purchase_id")
    )


def _shown_customers(latest):
    return latest.where("type <> 'delete'").select("pk", *[F.col("data")[c].alias(c) for c in ("name", "province_id")])


@query("snapshot_then_changes")
def _(spark, d):
    """The customers of a snapshot with the changes after its position."""
    feed = cdc.snapshot_then_changes(
        sample.customer_snapshot(spark, d), sample.customer_log(spark, d), "customer_info", sample.SNAPSHOT_AT
    )
    return _shown_customers(dedup_latest(feed.withColumn("pk", cdc.data("id")), ["pk"], "ts", ["xid"]))


@query("snapshot_then_changes_stream")
def _(spark, d):
    """The same, the snapshot written once and the overlapping log read as a stream."""
    folder = shared_dir(spark, "customers")
    table = jobs.snapshot_store(f"{folder}/table")
    jobs.load_snapshot(
        table, sample.customer_snapshot(spark, d), sample.in_batches(sample.customer_log(spark, d), "ts"),
        "customer_info", sample.SNAPSHOT_AT, f"{folder}/checkpoint",
    ).awaitTermination()
    return _shown_customers(table.read(spark))


def _reductions(spark, d, stream):
    records = {
        t: sample.in_batches(sample.change_records(spark, d, t), "ts", FEW) if stream else sample.change_records(spark, d, t)
        for t in ("order_detail", "order_detail_activity")
    }
    left = cdc.changes(records["order_detail"], "order_detail", ("insert",)).select(
        *cdc.fields("id", "order_id"), cdc.commit_time().alias("detail_time")
    )
    right = cdc.changes(records["order_detail_activity"], "order_detail_activity", ("insert",)).select(
        cdc.data("order_detail_id").alias("detail_id"), *cdc.fields("activity_id", "activity_rule_id"),
        cdc.commit_time().alias("activity_time"),
    )
    return left, right


def _shown_reductions(rows):
    return rows.select("id", "order_id", "detail_id", "activity_id", "activity_rule_id")


@query("trade_detail_activity")
def _(spark, d):
    left, right = _reductions(spark, d, False)
    return _shown_reductions(left.join(right, left.id == right.detail_id, "left"))


@query("trade_detail_activity_changes_stream")
def _(spark, d):
    """A left join that answers at once and takes back padded rows; its log, folded."""
    left, right = _reductions(spark, d, True)
    log = stateful.left_join_changes(left, right, "id", "detail_id", "detail_time", "activity_time", WAIT_MS)
    folder = shared_dir(spark, "stream")
    sinks.append_changes(log, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return _shown_reductions(stateful.fold_changes(spark.read.schema(log.schema).parquet(f"{folder}/out/*")))


@query("trade_pay_detail_from_feed")
def _(spark, d):
    """Payments of positions that come out of the change feed of a keyed table."""
    folder = shared_dir(spark, "details")
    # joined once; the batches below are cut from it
    trade_facts.order_detail(_wide(spark, d)).write.parquet(f"{folder}/all")
    details = spark.read.parquet(f"{folder}/all")
    table = sinks.KeyedTable(f"{folder}/table", ["id"], ["row_op_ts"])
    for n in range(3):
        table.write(details.where(F.pmod(F.xxhash64("id"), F.lit(3)) == n), n)
    table.write(details.where(F.pmod(F.xxhash64("id"), F.lit(3)) == 1), 3)  # a replay changes nothing
    feed = table.changes(spark).where("op <> 'delete'").select("after.*")
    return trade_facts.pay_detail(
        sample.change_records(spark, d, "payment_info"), feed, sample.dictionary(spark)
    ).withColumn("row_op_ts", ymd_hms(F.col("row_op_ts")))


HALF_WAY = "1998-07-01"


@query("payment_window_resumed_stream")
def _(spark, d):
    """The first half as a batch; the second as a stream that starts with the users of the first."""
    payments = trade_facts.pay_detail(
        sample.change_records(spark, d, "payment_info"), sample.order_detail_rows(spark, d), sample.dictionary(spark)
    )
    before = payments.where(F.col("callback_time") < HALF_WAY)
    last = {"order_detail_id": "last", "user_id": "last", "callback_time": "2100-01-01 00:00:00", "row_op_ts": "2100-01-01T00:00:00Z"}
    stream = sample.in_batches(
        payments.where(F.col("callback_time") >= HALF_WAY), "unix_seconds(CAST(callback_time AS TIMESTAMP))",
        FEW, last=_from_json(spark, payments.schema, json.dumps(last)),
    )
    later = trade_summary.payment_window(stream, settle_ms=WAIT_MS, history=trade_summary.payment_history(before))
    return trade_summary.payment_window(before).drop("ts").unionByName(_written(spark, later.drop("ts")))


@query("trade_cart_add_refreshed_stream")
def _(spark, d):
    """Cart facts of several micro-batches, named by a dictionary that is read again when it has aged."""
    folder = shared_dir(spark, "carts")
    names = ExpiringTable(lambda: sample.dictionary(spark), 1.0)
    jobs.append_enriched(
        _fed(spark, d, "cart_info"), trade_facts.cart_add, names, f"{folder}/out", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out/*")
