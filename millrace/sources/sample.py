"""Adapters: the sample tables seen as change records, logs, facts and dimensions.

Everything is derived by column expressions over whole tables, so the volume
grows with them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.codes import (
    BOOTSTRAP_INSERT,
    COUPON_GOT,
    COUPON_IN_ORDER,
    DEFAULT_DATABASE,
    DELETE,
    INSERT,
    ORDER_CANCELLED,
    ORDER_REFUND_ASKED,
    ORDER_REFUNDED,
    PAYMENT_PAID,
    REFUND_DONE,
    TIME_FORMAT,
    UPDATE,
)
from millrace.operators.dedup import dedup_latest
from millrace.session import shared_dir

# --- fixed values: the sample dictionary ------------------------------------
DICTIONARY_ROWS = [
    ("2401", "search"), ("2402", "promotion"), ("2403", "recommend"),
    ("1101", "alipay"), ("1102", "wechat"),
    ("1501", "refund only"), ("1502", "return and refund"),
    ("1301", "quality"), ("1302", "size"), ("1303", "other"),
    ("1201", "good"), ("1202", "fair"), ("1203", "bad"),
]
# ---------------------------------------------------------------------------

#: Total order among versions of one order position.
POSITION_ORDER = (
    "sku_id", "l_suppkey", "sku_num", "order_price", "l_discount", "l_tax", "rf", "l_linestatus",
)


#: Rows of a feed for which it gets a further file per range.
ROWS_PER_FILE = 100_000


class StreamDir(str):
    """A folder of sample tables, some of which are to be read as streams."""

    streaming: frozenset[str] = frozenset()

    @classmethod
    def of(cls, path: str, *streaming: str) -> StreamDir:
        folder = cls(path)
        folder.streaming = frozenset(streaming)
        return folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    at_rest = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in getattr(sf_dir, "streaming", ()):
        return at_rest
    return (
        spark.readStream.schema(at_rest.schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(str(sf_dir))
    )


def in_batches(rows: DataFrame, seconds: str, batches: int = 4, last: DataFrame | None = None) -> DataFrame:
    """``rows`` as a stream of several micro-batches in the order of ``seconds``, then ``last``.

    The rows are written to the shared folder range by range; each range is some files,
    which the stream takes together: as many as there are cores where rows are many.  They are
    written where they are read, without a shuffle, and empty files make up the number.  What they
    were cut from is removed, so the rows are stored once.
    """
    spark = rows.sparkSession
    folder = shared_dir(spark, "feed")
    kept = f"{folder}/all"
    rows.write.option("compression", "zstd").parquet(kept)
    stored = spark.read.schema(rows.schema).parquet(kept)
    files = max(4, min(spark.sparkContext.defaultParallelism, stored.count() // ROWS_PER_FILE))
    cuts = stored.selectExpr(f"CAST({seconds} AS DOUBLE) AS s").approxQuantile(
        "s", [i / batches for i in range(1, batches)], 0.01
    )
    lows, highs = [None, *cuts], [*cuts, None]
    for i, (low, high) in enumerate(zip(lows, highs, strict=True)):
        part = stored
        if low is not None:
            part = part.where(f"{seconds} > {low}")
        if high is not None:
            part = part.where(f"{seconds} <= {high}")
        at = f"{folder}/feed/{i:03d}"
        part.coalesce(files).write.option("compression", "zstd").parquet(at)
        for _ in range(files - len(spark.read.schema(rows.schema).parquet(at).inputFiles())):
            stored.limit(0).write.mode("append").parquet(at)
    whole = spark._jvm.org.apache.hadoop.fs.Path(kept)
    whole.getFileSystem(spark._jsc.hadoopConfiguration()).delete(whole, True)
    if last is not None:
        last.select(rows.columns).coalesce(1).write.parquet(f"{folder}/feed/{batches:03d}")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed/*")


def dictionary(spark: SparkSession) -> DataFrame:
    """The dictionary as literal rows: Spark knows their size, so facts are not shuffled by their few codes."""
    rows = ", ".join(f"('{code}', '{name}')" for code, name in DICTIONARY_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS dictionary(dic_code, dic_name)")


def _text(c: Column) -> Column:
    return c.cast("string")


# --- behaviour logs ---------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _page_columns(spark: SparkSession, sf_dir: str, with_item: bool = True) -> DataFrame:
    """Events with the text of the searched good; five events share a good."""
    if not with_item:
        return events(spark, sf_dir).withColumn("p_name", F.lit(None).cast("string"))
    goods = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    ev = events(spark, sf_dir)
    return ev.join(goods, F.expr("event_id div 5") == goods.p_partkey, "left")


def _common() -> Column:
    eid, uid = F.col("event_id"), F.col("user_id")
    return F.struct(
        _text(uid % 25).alias("ar"),
        F.when(uid % 3 == 0, "web").when(uid % 3 == 1, "Appstore").otherwise("xiaomi").alias("ch"),
        F.when(eid % 7 == 0, "1").otherwise("0").alias("is_new"),
        F.concat(F.lit("mid_"), _text(uid)).alias("mid"),
        _text(uid).alias("uid"),
        F.concat(F.lit("v2.1."), _text(eid % 3)).alias("vc"),
    )


def _page() -> Column:
    eid = F.col("event_id")
    kind, step = F.col("event_type"), eid % 10
    searched = step.isin(5, 6)
    return F.struct(
        F.when(kind == "view", "home").when(kind == "click", "good_detail")
        .when(kind == "signup", "login").when(kind == "purchase", "trade")
        .otherwise("good_list").alias("page_id"),
        F.when(step < 4, F.lit(None).cast("string")).when(step == 4, "login")
        .when(searched, "search").otherwise("home").alias("last_page_id"),
        F.when(searched, F.col("p_name")).otherwise(_text(eid % 200)).alias("item"),
        F.when(searched, "keyword").otherwise("sku_id").alias("item_type"),
        F.floor(F.col("value") * 10).cast("bigint").alias("during_time"),
    )


def page_log(spark: SparkSession, sf_dir: str, with_item: bool = False) -> DataFrame:
    """Page records, parsed: ``event_id, common, page, ts``.

    Searched texts need a join and are null unless asked for.
    """
    return _page_columns(spark, sf_dir, with_item).select(
        "event_id", _common().alias("common"), _page().alias("page"),
        F.unix_millis("ts").alias("ts"),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour logs as JSON text: errors, starts, pages with displays and actions.

    Some records are cut in half or have text after the object, so they are no JSON; some
    spell numbers as text or with a fraction, or hold an object where a list belongs.
    """
    eid = F.col("event_id")

    def items(count: Column, element) -> Column:
        return F.transform(
            F.when(count > 0, F.sequence(F.lit(1).cast("bigint"), count)).otherwise(
                F.array().cast("array<bigint>")
            ),
            element,
        )

    shown = items(
        eid % 3,
        lambda i: F.struct(
            F.lit("query").alias("display_type"), _text((eid + i) % 200).alias("item"),
            F.lit("sku_id").alias("item_type"), i.alias("order"), (i % 5).alias("pos_id"),
        ),
    )
    done = items(
        eid % 4,
        lambda i: F.struct(
            F.lit("favor_add").alias("action_id"), _text((eid + i) % 200).alias("item"),
            F.lit("sku_id").alias("item_type"), (F.unix_millis("ts") + i).alias("ts"),
        ),
    )
    is_start = eid % 13 == 0
    record = F.struct(
        _common().alias("common"),
        F.when(~is_start, _page()).alias("page"),
        F.when(~is_start, shown).alias("displays"),
        F.when(~is_start, done).alias("actions"),
        F.when(
            is_start,
            F.struct(F.lit("icon").alias("entry"), (eid % 900).alias("loading_time")),
        ).alias("start"),
        F.when(
            F.col("event_type") == "error",
            F.struct((eid % 500).alias("error_code"), F.lit("failed").alias("msg")),
        ).alias("err"),
        F.unix_millis("ts").alias("ts"),
    )
    text = F.to_json(record)
    # other spellings of numbers, a field of another type, text after the object
    text = F.when(eid % 41 == 0, F.regexp_replace(text, '"ts":([0-9]+)}$', '"ts":"$1"}')).otherwise(text)
    text = F.when(eid % 43 == 0, F.regexp_replace(text, '"ts":([0-9]+)}$', '"ts":$1.0}')).otherwise(text)
    text = F.when(eid % 37 == 0, F.regexp_replace(text, '"during_time":([0-9]+)', '"during_time":"$1"')).otherwise(text)
    text = F.when(
        eid % 101 == 0, F.regexp_replace(text, r'"displays":\[[^\]]*\]', '"displays":{"item":"1"}')
    ).otherwise(text)
    text = F.when(eid % 89 == 0, F.concat(text, F.lit(" xyz"))).otherwise(text)
    return _page_columns(spark, sf_dir).select(
        "event_id",
        F.when(eid % 97 == 0, F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int")))
        .otherwise(text)
        .alias("value"),
    )


# --- orders -----------------------------------------------------------------


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with user, province, status history."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "o_orderkey AS id",
        "o_custkey AS user_id",
        "c_nationkey AS province_id",
        "CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount",
        "timestamp_seconds(unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey % 86400)"
        " AS create_time",
        "o_orderstatus AS st",
        f"""CASE WHEN o_orderstatus = 'O' THEN '1001'
            WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '{ORDER_CANCELLED}'
            WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '{ORDER_REFUND_ASKED}'
            WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN '{ORDER_REFUNDED}'
            ELSE '1002' END AS new_status""",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN '1001' END AS old_status",
    )


def _position_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every version of an order position is made of, and its key."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS _key",
        "l_orderkey", "l_linenumber",
        "l_partkey AS sku_id",
        "CAST(l_quantity AS INT) AS sku_num",
        "CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price",
        "l_returnflag AS rf",
        "CAST(l_shipdate AS TIMESTAMP) AS row_op_ts",
        "l_suppkey", "l_linestatus", "l_tax", "l_discount",
    )


def _as_positions(versions: DataFrame) -> DataFrame:
    return versions.selectExpr(
        "l_orderkey * 10 + l_linenumber AS id",
        "l_orderkey AS order_id",
        "sku_id",
        "sku_num",
        "order_price",
        """CASE WHEN rf = 'A' THEN
            CAST(order_price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,4)) END
            AS split_activity_amount""",
        """CASE WHEN rf = 'R' THEN
            CAST(order_price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) END
            AS split_coupon_amount""",
        """CAST(order_price * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4))
            AS split_total_amount""",
        "CAST(2401 + l_suppkey % 4 AS STRING) AS source_type",
        "rf",
        "row_op_ts",
        "timestamp_seconds(unix_seconds(row_op_ts) + l_orderkey % 86400) AS create_time",
        "l_suppkey", "l_linestatus", "l_tax", "l_discount",
    )


def positions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order positions; ids repeat, as in a replayed change feed."""
    return _as_positions(_position_versions(spark, sf_dir))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each order position.

    Whatever is taken of a position comes out of the columns that order its versions, so
    details, activities and coupons of one job share one shuffle.
    """
    return _as_positions(dedup_latest(_position_versions(spark, sf_dir), ["_key"], "row_op_ts", POSITION_ORDER))


_POSITION_TEXT = (
    "id", "order_id", "sku_id", "order_price", "sku_num", "source_type",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
)


def order_detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-detail fact rows as text, with repeated ids."""
    o = order_info(spark, sf_dir).selectExpr(
        "id AS _order", "CAST(user_id AS STRING) AS user_id",
        "CAST(province_id AS STRING) AS province_id",
    )
    p = positions_raw(spark, sf_dir)
    return p.join(o, p.order_id == o["_order"]).selectExpr(
        *[f"CAST({c} AS STRING) AS {c}" for c in _POSITION_TEXT],
        "concat('sku_', sku_id) AS sku_name",
        "user_id", "province_id",
        "CASE WHEN rf = 'A' THEN CAST(id % 10 AS STRING) END AS activity_id",
        "CASE WHEN rf = 'A' THEN CAST(id % 20 AS STRING) END AS activity_rule_id",
        "CASE WHEN rf = 'R' THEN CAST(id % 7 AS STRING) END AS coupon_id",
        f"{_text_of('create_time')} AS create_time",
        "CAST(l_suppkey AS STRING) AS source_id",
        "source_type AS source_type_id", "source_type AS source_type_name", "row_op_ts",
    )


# --- change records ---------------------------------------------------------


def _text_of(time: str) -> str:
    return f"date_format({time}, '{TIME_FORMAT}')"


def _later(time: str, seconds: int) -> str:
    return f"timestamp_seconds(unix_seconds({time}) + {seconds})"


def _change(
    rows: DataFrame,
    name: str,
    kind: str,
    time: str,
    number: str,
    data: Mapping[str, str],
    old: Mapping[str, str] | None = None,
) -> DataFrame:
    """Envelopes around ``rows``; all values are SQL expressions."""

    def as_map(values: Mapping[str, str]) -> str:
        pairs = ", ".join(f"'{k}', CAST({v} AS STRING)" for k, v in values.items())
        return f"map({pairs})"

    return rows.selectExpr(
        f"'{DEFAULT_DATABASE}' AS database",
        f"'{name}' AS table",
        f"'{kind}' AS type",
        f"unix_seconds({time}) AS ts",
        f"CAST({number} AS BIGINT) AS xid",
        f"{as_map(data)} AS data",
        (as_map(old) if old else "CAST(NULL AS MAP<STRING, STRING>)") + " AS old",
    )


def _order_info_changes(spark, sf_dir):
    rows = order_info(spark, sf_dir)
    columns = {c: c for c in ("id", "user_id", "province_id", "total_amount")}
    columns["create_time"] = _text_of("create_time")
    later = _later("create_time", 600)
    first = _change(
        rows, "order_info", INSERT, "create_time", "id * 2",
        {**columns, "order_status": "'1001'"},
    )
    then = _change(
        rows.where("st <> 'O'"), "order_info", UPDATE, later, "id * 2 + 1",
        {**columns, "order_status": "new_status", "operate_time": _text_of(later)},
        {"order_status": "old_status"},
    )
    return first.unionByName(then)


def _order_detail_changes(spark, sf_dir):
    return _change(
        positions(spark, sf_dir), "order_detail", INSERT, "create_time", "id",
        {
            **{c: c for c in _POSITION_TEXT},
            "sku_name": "concat('sku_', sku_id)",
            "create_time": _text_of("create_time"),
            "source_id": "l_suppkey",
        },
    )


def _reduction_changes(spark, sf_dir, name, flag, columns):
    return _change(
        positions(spark, sf_dir).where(f"rf = '{flag}'"), name, INSERT, "create_time", "id",
        {"id": "id", "order_id": "order_id", "order_detail_id": "id", "sku_id": "sku_id", **columns},
    )


def _activity_changes(spark, sf_dir):
    return _reduction_changes(
        spark, sf_dir, "order_detail_activity", "A",
        {"activity_id": "id % 10", "activity_rule_id": "id % 20"},
    )


def _coupon_changes(spark, sf_dir):
    return _reduction_changes(
        spark, sf_dir, "order_detail_coupon", "R",
        {"coupon_id": "id % 7", "coupon_use_id": "id % 70"},
    )


def _payment_changes(spark, sf_dir):
    paid_at = _later("create_time", 600)
    return _change(
        order_info(spark, sf_dir).where("st IN ('P', 'O')"), "payment_info", UPDATE, paid_at, "id",
        {
            "order_id": "id", "user_id": "user_id", "payment_type": "1101 + id % 3",
            "callback_time": _text_of(paid_at),
            "payment_status": f"CASE WHEN st = 'P' THEN '{PAYMENT_PAID}' ELSE '1601' END",
        },
        {"payment_status": "'1601'"},
    )


def _refunded_positions(spark, sf_dir, status):
    p = positions(spark, sf_dir)
    o = order_info(spark, sf_dir).where(f"new_status = '{status}'").selectExpr(
        "id AS _order", "user_id", "create_time AS order_time"
    )
    return p.join(o, p.order_id == o["_order"])


def _refund_info_changes(spark, sf_dir):
    columns = {
        "id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
        "refund_type": "1501 + id % 2", "refund_num": "sku_num",
        "refund_amount": "split_total_amount", "refund_reason_type": "1301 + id % 3",
        "refund_reason_txt": "concat('reason ', id % 10)", "create_time": _text_of("order_time"),
    }
    asked = _change(
        _refunded_positions(spark, sf_dir, ORDER_REFUND_ASKED), "order_refund_info", INSERT,
        "order_time", "id", {**columns, "refund_status": "'0701'"},
    )
    done = _change(
        _refunded_positions(spark, sf_dir, ORDER_REFUNDED), "order_refund_info", UPDATE,
        "order_time", "id", {**columns, "refund_status": f"'{REFUND_DONE}'"},
        {"refund_status": "'0701'"},
    )
    return asked.unionByName(done)


def _refund_payment_changes(spark, sf_dir):
    done_at = _later("order_time", 600)
    return _change(
        _refunded_positions(spark, sf_dir, ORDER_REFUNDED), "refund_payment", UPDATE, done_at, "id",
        {
            "id": "id", "out_trade_no": "concat('out_', id)", "order_id": "order_id",
            "sku_id": "sku_id", "payment_type": "1101 + id % 3", "trade_no": "concat('trade_', id)",
            "total_amount": "split_total_amount", "subject": "'refund'",
            "refund_status": f"'{REFUND_DONE}'", "create_time": _text_of("order_time"),
            "callback_time": _text_of(done_at), "callback_content": "'ok'",
        },
        {"refund_status": "'0701'"},
    )


def _cart_changes(spark, sf_dir):
    rows = events(spark, sf_dir).where("event_type = 'click'")
    columns = {
        "id": "event_id", "user_id": "user_id", "sku_id": "event_id % 200",
        "cart_price": "CAST(value AS DECIMAL(16,2))", "sku_num": "event_id % 7 + 1",
        "sku_name": "concat('sku_', event_id % 200)", "is_checked": "'1'",
        "create_time": _text_of("ts"), "is_ordered": "'0'",
        "source_type": "2401 + event_id % 4", "source_id": "event_id % 50",
    }
    touched = _later("ts", 1800)
    added = _change(
        rows.where("event_id % 2 = 0"), "cart_info", INSERT, "ts", "event_id", columns
    )
    raised = _change(
        rows.where("event_id % 2 = 1"), "cart_info", UPDATE, touched, "event_id",
        {**columns, "operate_time": _text_of(touched)},
        {"sku_num": "CASE WHEN event_id % 11 <> 0 THEN event_id % 5 + 1 END"},
    )
    return added.unionByName(raised)


def _coupon_use_changes(spark, sf_dir):
    rows = events(spark, sf_dir).where("event_type = 'purchase'")
    at = _text_of("ts")
    columns = {"id": "event_id", "coupon_id": "event_id % 20", "user_id": "user_id"}
    ordered = {**columns, "order_id": "event_id * 3"}
    got = _change(
        rows.where("event_id % 3 = 0"), "coupon_use", INSERT, "ts", "event_id",
        {**columns, "coupon_status": f"'{COUPON_GOT}'", "get_time": at},
    )
    used = _change(
        rows.where("event_id % 3 = 1"), "coupon_use", UPDATE, "ts", "event_id",
        {**ordered, "coupon_status": f"'{COUPON_IN_ORDER}'", "using_time": at},
        {"coupon_status": f"CASE WHEN event_id % 5 = 0 THEN '1400' ELSE '{COUPON_GOT}' END"},
    )
    paid = _change(
        rows.where("event_id % 3 = 2"), "coupon_use", UPDATE, "ts", "event_id",
        {**ordered, "coupon_status": "'1403'", "used_time": at},
        {"coupon_status": f"'{COUPON_IN_ORDER}'"},
    )
    return got.unionByName(used).unionByName(paid)


def _event_inserts(name, event_type, columns):
    def build(spark, sf_dir):
        rows = events(spark, sf_dir).where(f"event_type = '{event_type}'")
        return _change(
            rows, name, INSERT, "ts", "event_id", {**columns, "create_time": _text_of("ts")}
        )

    return build


_favor_changes = _event_inserts(
    "favor_info", "view", {"id": "event_id", "user_id": "user_id", "sku_id": "event_id % 200"}
)
_comment_changes = _event_inserts(
    "comment_info", "error",
    {
        "id": "event_id", "user_id": "user_id", "sku_id": "event_id % 200",
        "order_id": "event_id * 3", "appraise": "1201 + event_id % 4",
    },
)
_user_changes = _event_inserts("user_info", "signup", {"id": "event_id"})


# --- dimensions -------------------------------------------------------------


def _part(spark, sf_dir):
    return table(spark, sf_dir, "part")


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        _text(F.col("n_nationkey")).alias("id"), F.col("n_name").alias("name")
    )


def sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select(
        _text(F.col("p_partkey")).alias("id"), _text(F.col("p_partkey") % 50).alias("spu_id"),
        F.col("p_brand").alias("tm_id"), F.col("p_type").alias("category3_id"),
    )


def spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product groups; those from 40 on are missing."""
    number = F.col("p_partkey") % 50
    return (
        _part(spark, sf_dir).select(number.alias("n")).distinct().where("n < 40")
        .select(_text(F.col("n")).alias("id"), F.concat(F.lit("spu_"), _text(F.col("n"))).alias("spu_name"))
    )


def trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select(F.col("p_brand").alias("id")).distinct().select(
        "id", F.upper("id").alias("tm_name")
    )


def category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part(spark, sf_dir).select(F.col("p_type").alias("id")).distinct().select(
        "id", F.concat(F.lit("c3 "), F.col("id")).alias("name"),
        _text(F.length("id") % 3).alias("category2_id"),
    )


def category2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category3(spark, sf_dir).select(F.col("category2_id").alias("id")).distinct().select(
        "id", F.concat(F.lit("c2 "), F.col("id")).alias("name"),
        _text(F.col("id").cast("int") % 2).alias("category1_id"),
    )


def category1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category2(spark, sf_dir).select(F.col("category1_id").alias("id")).distinct().select(
        "id", F.concat(F.lit("c1 "), F.col("id")).alias("name")
    )


_LOADED = "timestamp_seconds(1600000000)"


def _province_changes(spark, sf_dir):
    return _change(
        table(spark, sf_dir, "nation"), "base_province", BOOTSTRAP_INSERT, _LOADED, "n_nationkey",
        {
            "id": "n_nationkey", "name": "n_name", "region_id": "n_regionkey",
            "area_code": "n_nationkey + 100",
        },
    )


def _sku_changes(spark, sf_dir):
    rows = _part(spark, sf_dir)
    price = "CAST(p_retailprice AS DECIMAL(16,2))"
    columns = {
        "id": "p_partkey", "sku_name": "p_name", "tm_id": "p_brand", "category3_id": "p_type",
        "price": price, "weight": "p_size",
    }
    first = _change(rows, "sku_info", BOOTSTRAP_INSERT, _LOADED, "p_partkey", columns)
    repriced = _change(
        rows.where("p_size > 25"), "sku_info", UPDATE,
        "timestamp_seconds(1600000000 + p_size)", "p_partkey",
        {**columns, "price": "CAST(p_retailprice * 2 AS DECIMAL(16,2))"}, {"price": price},
    )
    removed = _change(
        rows.where("p_size > 45"), "sku_info", DELETE, _later(_LOADED, 1000), "p_partkey", columns
    )
    return first.unionByName(repriced).unionByName(removed)


def _customer_changes(spark, sf_dir):
    return _change(
        table(spark, sf_dir, "customer"), "customer_info", INSERT, _LOADED, "c_custkey",
        {
            "id": "c_custkey", "name": "c_name", "province_id": "c_nationkey",
            "segment": "c_mktsegment",
        },
    )


def _supplier_changes(spark, sf_dir):
    """A table no route exists for."""
    return _change(
        table(spark, sf_dir, "supplier"), "supplier_info", INSERT, _LOADED, "s_suppkey",
        {"id": "s_suppkey", "name": "s_name"},
    )


_CHANGES = {
    "order_info": _order_info_changes,
    "order_detail": _order_detail_changes,
    "order_detail_activity": _activity_changes,
    "order_detail_coupon": _coupon_changes,
    "payment_info": _payment_changes,
    "order_refund_info": _refund_info_changes,
    "refund_payment": _refund_payment_changes,
    "cart_info": _cart_changes,
    "coupon_use": _coupon_use_changes,
    "favor_info": _favor_changes,
    "comment_info": _comment_changes,
    "user_info": _user_changes,
    "base_province": _province_changes,
    "sku_info": _sku_changes,
    "customer_info": _customer_changes,
    "supplier_info": _supplier_changes,
}


def change_records(spark: SparkSession, sf_dir: str, *tables: str) -> DataFrame:
    """Change envelopes of the named tables (all of them if none is named)."""
    frames = [_CHANGES[t](spark, sf_dir) for t in (tables or _CHANGES)]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


#: Commit time and transaction at which the snapshot of the customers was taken.
SNAPSHOT_AT = (1_704_067_200, 0)


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as a table was at ``SNAPSHOT_AT``; every eleventh was deleted before."""
    return table(spark, sf_dir, "customer").where("c_custkey % 11 <> 0").selectExpr(
        "CAST(c_custkey AS STRING) AS id", "c_name AS name", "CAST(c_nationkey AS STRING) AS province_id"
    )


def customer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the customers; those up to the position of the snapshot overlap with it."""
    rows = table(spark, sf_dir, "customer")
    at, _ = SNAPSHOT_AT
    names = {"id": "c_custkey", "name": "c_name", "province_id": "c_nationkey"}
    time = lambda seconds: f"timestamp_seconds({at} + ({seconds}))"
    parts = [
        _change(rows, "customer_info", INSERT, time("c_custkey % 500 - 1000"), "c_custkey", {**names, "name": "'before'"}),
        _change(rows.where("c_custkey % 11 = 0"), "customer_info", DELETE, time("-100"), "c_custkey", names),
        _change(rows.where("c_custkey % 3 = 0 AND c_custkey % 11 <> 0"), "customer_info", UPDATE,
                time("1 + c_custkey % 1000"), "c_custkey", {**names, "name": "upper(c_name)"}, {"name": "c_name"}),
        _change(rows.where("c_custkey % 7 = 0 AND c_custkey % 11 <> 0"), "customer_info", DELETE, time("2000"), "c_custkey", names),
        _change(rows.where("c_custkey % 5 = 0"), "customer_info", INSERT, time("3000 + c_custkey % 10"), "c_custkey",
                {**names, "id": "c_custkey + 1000000"}),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- fixed values: the history of a routing configuration ---------------------
#: source table, sink table, kept columns, primary key, operation, time of the change
ROUTE_HISTORY = [
    ("cart_info", "dim_cart", "id,user_id", None, "c", "2024-01-05 00:00:00"),
    ("cart_info", "dim_cart_goods", "id,sku_id,sku_num", "", "u", "2024-01-15 12:00:00"),
    ("cart_info", "dim_cart_goods", "id,sku_id,sku_num", "", "d", "2024-01-22 00:00:00"),
    ("cart_info", "dim_cart", "id,user_id,sku_num", "user_id", "c", "2024-01-26 00:00:00"),
    ("favor_info", "dim_favor", "id,sku_id", "id", "r", "2024-01-10 12:00:00"),
]
# ---------------------------------------------------------------------------


def route_history(spark: SparkSession) -> DataFrame:
    """Changes of the routing configuration while the records come in."""
    rows = spark.createDataFrame(
        ROUTE_HISTORY,
        "source_table string, sink_table string, sink_columns string, sink_pk string, op string, at string",
    ).withColumn("ts_ms", F.unix_millis(F.col("at").cast("timestamp")))
    image = F.struct("source_table", "sink_table", "sink_columns", "sink_pk")
    return rows.select(
        F.when(F.col("op").isin("u", "d"), image).alias("before"), F.when(F.col("op") != "d", image).alias("after"), "op", "ts_ms"
    )


# --- fixed values: the sample routing configuration ---------------------------
#: source table, sink table, kept columns, primary key, operation, change time
ROUTE_CHANGES = [
    ("base_province", "dim_base_province", "id,name", None, "c", 1),
    ("base_province", "dim_base_province", "id,name,area_code", None, "u", 2),
    ("sku_info", "dim_sku_info", "id,sku_name,tm_id,category3_id,price", "id", "r", 1),
    ("customer_info", "dim_customer_info", "id,name,province_id", "", "c", 1),
    ("user_info", "dim_user_info", "id,create_time", "id", "c", 1),
    ("user_info", "dim_user_info", "id,create_time", "id", "d", 2),
]
# ---------------------------------------------------------------------------


def route_change_text(spark: SparkSession) -> DataFrame:
    """The routing configuration as text change records."""
    rows = spark.createDataFrame(
        ROUTE_CHANGES,
        "source_table string, sink_table string, sink_columns string, sink_pk string, "
        "op string, ts_ms bigint",
    )
    image = F.struct("source_table", "sink_table", "sink_columns", "sink_pk")
    return rows.select(
        F.to_json(
            F.struct(
                F.when(F.col("op").isin("u", "d"), image).alias("before"),
                F.when(F.col("op") != "d", image).alias("after"),
                "op", "ts_ms",
            )
        ).alias("value")
    )
