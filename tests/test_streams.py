"""Streams give what the batch forms give, in any arrival order and across restarts."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from checks.oracle import ORACLE
from helpers import LOG_SCHEMA, change, changes, dictionary, ms, page, page_log
from millrace import schemas
from millrace.operators import cdc, logs, routing
from millrace.plans import trade_facts, trade_summary, traffic_facts, traffic_summary, user_summary
from millrace.session import shared_dir
from millrace.sources import readers
from millrace.streaming import jobs, sinks, stateful

#: A row far in the future moves the watermark past all others.
LAST = page(10**6, "last", "2030-01-01 00:00:00", uid="last")


@pytest.fixture
def folder(spark):
    return shared_dir(spark, "test")


def feed(spark, folder, *batches, schema=LOG_SCHEMA):
    """A stream that delivers each batch of rows in a micro-batch of its own."""
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(
            f"{folder}/in/{n:03d}"
        )
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in/*")
    )


def run(spark, folder, stream):
    sinks.append_table(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_until(spark, folder, stream, enough, limit=60):
    """Run a query that waits by the clock (and so never ends by itself) until ``enough`` rows."""
    query = sinks.append_table(
        stream, f"{folder}/out", f"{folder}/checkpoint", {"processingTime": "0 seconds"}
    )
    try:
        end = time.time() + limit
        while time.time() < end:
            got = spark.read.schema(stream.schema).parquet(f"{folder}/out")
            if got.count() >= enough:
                return got
            time.sleep(0.5)
            if query.exception():
                raise query.exception()
        raise AssertionError("the query did not deliver in time")
    finally:
        query.stop()


def random_pages(seed, n=400):
    rng = random.Random(seed)
    start = ms("2024-01-01 23:00:00")
    out = []
    for i in range(n):
        p = page(
            i, f"m{rng.randrange(5)}", "2024-01-01 00:00:00", rng.choice([None, "login", "home"]),
            rng.choice(["home", "good_detail", "x"]), uid=f"u{rng.randrange(4)}",
        )
        out.append((*p[:3], start + rng.randrange(3 * 3600 * 1000)))
    return out


def shuffled_batches(pages, parts=3):
    """Rows in time order across batches (no row is late), shuffled inside each."""
    rng = random.Random(1)
    ordered = sorted(pages, key=lambda p: p[3])
    size = -(-len(ordered) // parts)
    batches = [ordered[i:i + size] for i in range(0, len(ordered), size)]
    for b in batches:
        rng.shuffle(b)
    return [*batches, [LAST]]


def no_last(df):
    return df.where("event_id < 1000000")


def test_unique_visitors(spark, rows, folder):
    pages = random_pages(1)
    got = run(
        spark, folder,
        traffic_facts.unique_visitors(feed(spark, folder, *shuffled_batches(pages)), ["event_id"]),
    )
    want = traffic_facts.unique_visitors(page_log(spark, pages), ["event_id"])
    assert rows(no_last(got)) == rows(want)


def test_user_jumps(spark, rows, folder):
    pages = random_pages(2)
    within = 120_000
    got = run(
        spark, folder,
        traffic_facts.user_jumps(
            feed(spark, folder, *shuffled_batches(pages)), within, ["event_id"]
        ),
    )
    want = traffic_facts.user_jumps(page_log(spark, pages), within, ["event_id"])
    assert rows(no_last(got)) == rows(want)
    assert 0 < want.count() < len(pages)


def closed(df):
    return df.drop("ts").where("stt < '2029'")


def test_page_visitors_per_window(spark, rows, folder):
    pages = random_pages(3)
    got = run(
        spark, folder,
        traffic_summary.page_uv_window(
            feed(spark, folder, *shuffled_batches(pages), [(*LAST[:2], ("home", "", "", "", 1), LAST[3])])
        ),
    )
    want = traffic_summary.page_uv_window(page_log(spark, pages))
    assert rows(closed(got)) == rows(closed(want))


def test_logins_per_window(spark, rows, folder):
    pages = random_pages(4)
    got = run(
        spark, folder,
        user_summary.user_login_window(
            feed(spark, folder, *shuffled_batches(pages)), "1 hour", gap_days=0
        ),
    )
    want = user_summary.user_login_window(page_log(spark, pages), "1 hour", gap_days=0)
    assert rows(closed(got)) == rows(closed(want))


def test_traffic_measures_per_window(spark, rows, folder):
    """Visitors and jumps come back in as streams of their own, as topics would."""
    pages = random_pages(5)
    log = page_log(spark, pages)
    visitors = traffic_facts.unique_visitors(log, ["event_id"])
    jumps = traffic_facts.user_jumps(log, 120_000, ["event_id"])
    streams = [
        feed(spark, f"{folder}/{n}", [tuple(r) for r in df.collect()], [LAST])
        for n, df in enumerate((log, visitors, jumps))
    ]
    got = run(spark, folder, traffic_summary.traffic_dims_window(*streams, size="1 hour"))
    want = traffic_summary.traffic_dims_window(log, visitors, jumps, size="1 hour")
    assert rows(closed(got)) == rows(closed(want))


def test_late_rows_are_dropped_and_rows_within_the_delay_count(spark, rows, folder):
    batches = [
        [page(1, "a", "2024-01-01 00:00:11")],
        [page(2, "a", "2024-01-01 00:00:09")],      # late by two seconds: still open
        [page(3, "a", "2024-01-01 00:01:00")],
        [page(5, "a", "2024-01-01 00:02:00")],      # the watermark moves between batches only
        [page(4, "a", "2024-01-01 00:00:05")],      # its window is closed
        [LAST],
    ]
    stream = feed(spark, folder, *batches).withColumn("t", F.timestamp_millis("ts"))
    from millrace.operators.windows import tumble, with_event_time

    got = run(
        spark, folder,
        tumble(with_event_time(stream, "t"), "t", [F.count(F.lit(1)).alias("n")]),
    )
    assert rows(got.where("stt < '2029'"), "stt", "n") == [
        ("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:10", 1), ("2024-01-01 00:01:00", 1),
        ("2024-01-01 00:02:00", 1),
    ]


def test_restart_from_checkpoint_gives_the_same(spark, rows, folder):
    pages = random_pages(6)
    batches = shuffled_batches(pages, parts=4)

    def job(stream):
        return traffic_facts.unique_visitors(stream, ["event_id"])

    run(spark, folder, job(feed(spark, folder, *batches[:2])))
    for n, batch in enumerate(batches[2:], start=2):
        spark.createDataFrame(batch, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{folder}/in/{n:03d}"
        )
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(
        f"{folder}/in/*"
    )
    got = run(spark, folder, job(stream))
    assert rows(no_last(got)) == rows(job(page_log(spark, pages)))


VERSION = "id string, version timestamp, what string"


def test_keep_latest_waits_then_emits_the_newest(spark, rows, folder):
    versions = spark.sql(
        "SELECT * FROM VALUES ('1', timestamp'2024-01-01 00:00:01', 'new'), "
        "('1', timestamp'2024-01-01 00:00:00', 'old'), ('2', timestamp'2024-01-01 00:00:00', 'only') "
        "AS t(id, version, what)"
    )
    stream = feed(spark, folder, [tuple(r) for r in versions.collect()], schema=VERSION)
    latest = stateful.keep_latest(stream, "id", "version", delay_ms=0)
    os.makedirs(f"{folder}/out")
    got = run_until(spark, folder, latest, 2)
    assert rows(got, "id", "what") == [("1", "new"), ("2", "only")]


DETAIL = (
    "id string, order_id string, user_id string, sku_id string, sku_num string, "
    "order_price string, province_id string, create_time string, split_activity_amount string, "
    "split_coupon_amount string, split_total_amount string, row_op_ts timestamp"
)


def order_rows(spark):
    text = [
        ("1", "o1", "u", "2024-01-01 10:00:00", "1.25"),
        ("2", "o1", "u", "2024-01-01 10:00:03", None),
        ("3", "o2", "u", "2024-01-02 10:00:00", None),
        ("4", "o3", "u", "2024-01-02 10:00:20", None),
        ("5", "o4", "w", "2024-01-02 10:00:21", None),
        ("6", "last", "last", "2030-01-01 00:00:00", None),
    ]
    df = spark.createDataFrame(text, "id string, order_id string, user_id string, create_time string, split_activity_amount string")
    return df.select(
        "id", "order_id", "user_id", F.lit("s").alias("sku_id"), F.lit("2").alias("sku_num"),
        F.lit("5.50").alias("order_price"), F.lit("1").alias("province_id"), "create_time",
        "split_activity_amount", F.lit(None).cast("string").alias("split_coupon_amount"),
        F.lit("10.00").alias("split_total_amount"),
        F.col("create_time").cast("timestamp").alias("row_op_ts"),
    )


@pytest.mark.parametrize("summary", ["order", "province", "spu"])
def test_order_summaries(spark, rows, folder, monkeypatch, summary):
    """Keep-latest by arrival, then first visits by event time, then windows: one query."""
    real = stateful.keep_latest
    # no waiting in a stream that ends
    monkeypatch.setattr(stateful, "keep_latest", lambda df, key, version, tie: real(df, key, version, tie, 0))
    provinces = spark.createDataFrame([("1", "north")], "id string, name string")

    def dim(columns, *values):
        return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c in columns.split()))

    build = {
        "order": trade_summary.order_window,
        "province": lambda df: trade_summary.province_order_window(df, provinces),
        "spu": lambda df: trade_summary.user_spu_order_window(
            df, dim("id spu_id tm_id category3_id", ("s", "p", "t", "c3")),
            dim("id spu_name", ("p", "P")), dim("id tm_name", ("t", "T")),
            dim("id name category2_id", ("c3", "C3", "c2")),
            dim("id name category1_id", ("c2", "C2", "c1")), dim("id name", ("c1", "C1")),
        ),
    }[summary]
    batch = order_rows(spark)
    data = [tuple(r) for r in batch.collect()]
    stream = build(feed(spark, folder, data[:5], data[5:], schema=DETAIL))
    want = rows(closed(build(batch)))
    os.makedirs(f"{folder}/out")
    got = run_until(spark, folder, stream, len(want))
    assert rows(closed(got)) == want


def order_changes():
    at = ms("2024-01-01 10:00:00") // 1000
    out = []
    for n, (activity, coupon) in enumerate([(True, False), (False, True), (False, False), (True, True)]):
        number = str(n)
        t = at + 10 * n
        out += [
            change("order_detail", "insert",
                   {"id": number, "order_id": f"o{n}", "source_type": "2401", "sku_id": "s"}, ts=t),
            change("order_info", "insert",
                   {"id": f"o{n}", "user_id": "u", "order_status": "1001"}, ts=t + 1),
        ]
        if activity:
            out.append(change("order_detail_activity", "insert",
                              {"id": f"a{n}", "order_detail_id": number, "activity_id": "7"}, ts=t + 2))
        if coupon:
            out.append(change("order_detail_coupon", "insert",
                              {"id": f"c{n}", "order_detail_id": number, "coupon_id": "8"}, ts=t + 2))
    # a cancellation some minutes later
    out.append(change("order_info", "update",
                      {"id": "o0", "user_id": "u", "order_status": "1003",
                       "operate_time": "2024-01-01 10:10:00"},
                      {"order_status": "1001"}, ts=at + 600))
    # a position whose source has no name
    out.append(change("order_detail", "insert",
                      {"id": "x", "order_id": "o1", "source_type": "2499"}, ts=at))
    return out


def future(ts=1_900_000_000):
    tables = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    return [
        change(t, "insert", {"id": "last", "order_id": "last", "order_detail_id": "last",
                             "source_type": "2401"}, ts=ts)
        for t in tables
    ]


def test_order_joins(spark, rows, folder):
    names = dictionary(spark, c2401="search")
    columns = ("id", "order_id", "type", "activity_id", "coupon_id", "source_type_name", "row_op_ts")
    want = trade_facts.order_wide(changes(spark, order_changes()), names)
    stream = feed(spark, folder, order_changes(), future(), schema=schemas.CDC)
    got = run(spark, folder, trade_facts.order_wide(stream, names))
    assert rows(got.where("id <> 'last'"), *columns) == rows(want, *columns)
    assert want.count() == 5
    cancelled = trade_facts.order_cancel(got)
    assert rows(cancelled, "id", "cancel_time") == [("0", "2024-01-01 10:10:00")]


@pytest.mark.parametrize("retention, found", [("905 seconds", ["in"]), ("2 days", ["in", "out"])])
def test_joins_keep_rows_for_the_retention_and_no_longer(spark, folder, retention, found):
    at = ms("2024-01-01 10:00:00") // 1000
    first = [change("order_detail", "insert", {"id": n, "order_id": n, "source_type": "2401"}, ts=at) for n in ("in", "out")]
    later = [change("order_info", "insert", {"id": n, "user_id": "u"}, ts=at + s) for n, s in (("in", 900), ("out", 86_400))]
    stream = feed(spark, folder, first, later, future(), schema=schemas.CDC)
    wide = trade_facts.order_wide(stream, dictionary(spark, c2401="search"), retention=retention)
    got = run(spark, folder, wide)
    assert sorted(r.id for r in got.where("id <> 'last'").collect()) == found


def test_registered_stream_joins_are_held_against_the_batch_sql():
    assert ORACLE["trade_order_wide_stream"] == ORACLE["trade_order_wide"]
    assert ORACLE["trade_pay_detail_stream"] == ORACLE["trade_pay_detail"]


def test_payment_joins(spark, rows, folder):
    names = dictionary(spark, c2401="search", c1101="wallet")
    at = ms("2024-01-01 10:00:00") // 1000
    pay = [
        change("payment_info", "update", {"order_id": f"o{n}", "payment_type": "1101", "callback_time": "x",
                                          "payment_status": status}, ts=at + 300)
        for n, status in enumerate(["1602", "1601", "1602"])
    ]
    end = [change("payment_info", "update", {"order_id": "last", "payment_type": "1101",
                                             "payment_status": "1602"}, ts=1_900_000_000)]
    wide = trade_facts.order_wide(changes(spark, order_changes()), names)
    details = trade_facts.order_detail(wide)
    want = trade_facts.pay_detail(changes(spark, pay), details, names)
    detail_stream = feed(spark, f"{folder}/d", [tuple(r) for r in details.collect()],
                         schema=details.schema)
    pay_stream = feed(spark, f"{folder}/p", pay, end, schema=schemas.CDC)
    got = run(spark, folder, trade_facts.pay_detail(pay_stream, detail_stream, names))
    assert rows(got, "order_detail_id", "payment_type_name") == rows(
        want, "order_detail_id", "payment_type_name"
    ) == [("0", "wallet"), ("2", "wallet")]


def test_router_writes_each_output_once_even_if_a_batch_repeats(spark, folder):
    good = json.dumps({"common": {"mid": "m"}, "page": {"page_id": "home"},
                       "displays": [{"item": "1"}], "err": {"c": 1}, "ts": 1})
    raw = feed(spark, folder, [(good,), ("{bad",)], [(good,)], schema="value string")
    query = jobs.route_logs(logs.parse_logs(raw), f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()

    def count(name):
        return spark.read.parquet(f"{folder}/out/{name}").count()

    counts = {n: count(n) for n in ("dirty", "error", "start", "display", "action", "page")}
    assert counts == {"dirty": 1, "error": 2, "start": 0, "display": 2, "action": 0, "page": 2}


def dimension(kind, number, name, ts):
    return change("a", kind, {"id": number, "name": name}, ts=ts)


def test_dimension_table_from_a_stream(spark, rows, folder):
    route = {"op": "c", "ts_ms": 1, "after": {"source_table": "a", "sink_table": "dim_a",
                                              "sink_columns": "id,name"}}
    config = spark.createDataFrame([(json.dumps(route),)], "value string")
    stream = feed(
        spark, folder,
        [dimension("insert", "1", "one", 1), dimension("update", "1", "uno", 2)],
        [dimension("update", "1", "stale", 1), dimension("insert", "2", "two", 3)],
        schema=schemas.CDC,
    )
    jobs.load_dimensions(
        stream, lambda: routing.current_routes(readers.route_changes(config)),
        f"{folder}/table", f"{folder}/checkpoint",
    ).awaitTermination()
    store = jobs.dimension_store(f"{folder}/table")
    want = [("1", "uno"), ("2", "two")]
    assert rows(routing.dimension_table(store.read(spark), "dim_a", ["id", "name"])) == want
    compacted = store.compact(spark, f"{folder}/compacted", 1)
    assert rows(routing.dimension_table(compacted.read(spark), "dim_a", ["id", "name"])) == want


def test_keyed_table_repeats_and_deletions(spark, rows, folder):
    table = sinks.KeyedTable(folder, ["k"], ["v"])

    def batch(*values):
        return spark.createDataFrame(list(values), "k string, v int, gone boolean")

    table.write(batch(("a", 1, False), ("a", 2, False), ("b", 1, False)), 0)
    table.write(batch(("b", 2, True)), 1)
    table.write(batch(("b", 2, True)), 1)
    assert rows(table.read(spark), "k", "v") == [("a", 2), ("b", 2)]
    assert rows(table.read(spark, deleted="gone"), "k", "v") == [("a", 2)]


def test_keyed_table_folds_while_it_is_written(spark, rows, folder):
    table = sinks.KeyedTable(folder, ["k"], ["v"], "k string, v int, gone boolean", "k", fold_every=3)
    assert table.read(spark).collect() == []
    newest = {}
    for n in range(8):
        values = [(f"k{(n * i) % 5}", n * 10 + i, False) for i in range(3)]
        for k, v, _ in values:
            newest[k] = max(v, newest.get(k, -1))
        table.write(spark.createDataFrame(values, "k string, v int, gone boolean"), n)
        assert rows(table.read(spark), "k", "v") == sorted(newest.items())
    assert table._finished(spark, "snapshots") == [2, 5]
    # what a failed try leaves behind does not count
    os.makedirs(f"{folder}/snapshots/batch_id=7/k=k0")
    os.makedirs(f"{folder}/batches/batch_id=9/k=k0")
    assert rows(table.read(spark), "k", "v") == sorted(newest.items())
    read = table.read(spark).where("k = 'k1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in read


def test_unwritten_table_without_schema_says_so(spark, folder):
    with pytest.raises(ValueError, match="nothing was written"):
        sinks.KeyedTable(f"{folder}/none", ["k"], ["v"]).read(spark)


def test_text_sink_reads_back(spark, rows, folder):
    stream = feed(spark, folder, [page(1, "a", "2024-01-01 00:00:00")])
    sinks.append_text(stream.select("event_id", "ts"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    back = readers.json_table(readers.text_files(spark, f"{folder}/out"), stream.select("event_id", "ts").schema)
    assert rows(back) == [(1, ms("2024-01-01 00:00:00"))]
    again = readers.text_stream(spark, f"{folder}/out")
    assert again.isStreaming and again.columns == ["value"]
    assert cdc.CORRUPT not in back.columns


def refund_changes():
    at = ms("2024-01-01 10:00:00") // 1000
    done, undone = {"refund_status": "0705"}, {"refund_status": "0701"}
    out = [
        change("order_info", "update", {"id": "o1", "user_id": "u", "province_id": "3",
                                        "order_status": "1005"}, {"order_status": "1002"}, ts=at),
        change("order_info", "update", {"id": "o2", "user_id": "u", "order_status": "1005"},
               {"operate_time": "x"}, ts=at),  # the status did not change
        change("order_info", "update", {"id": "o3", "user_id": "w", "province_id": "4",
                                        "order_status": "1006"}, {"order_status": "1005"}, ts=at),
    ]
    for n in ("1", "2"):
        out.append(change("order_refund_info", "insert",
                          {"id": n, "order_id": f"o{n}", "refund_type": "1501",
                           "refund_reason_type": "1301"}, ts=at + 1))
        # two goods of one order, both refunded
        out.append(change("order_refund_info", "update",
                          {"order_id": "o3", "sku_id": f"s{n}", "refund_num": n, **done}, undone, ts=at + 2))
        out.append(change("refund_payment", "update",
                          {"id": f"p{n}", "order_id": "o3", "sku_id": f"s{n}", "payment_type": "1101",
                           **done}, undone, ts=at + 3))
    return out


REFUND_NAMES = {"c1501": "refund only", "c1301": "size", "c1101": "wallet"}


def test_refund_joins_batch(spark, rows):
    records, names = changes(spark, refund_changes()), dictionary(spark, **REFUND_NAMES)
    assert rows(
        trade_facts.order_refund(records, names), "id", "province_id", "type_dic_name", "reason_dic_name"
    ) == [("1", "3", "refund only", "size")]
    by_order = trade_facts.refund_detail(records, names, by_sku=False)
    assert rows(by_order, "id", "refund_num", "payment_name", "user_id") == [
        ("p1", "1", "wallet", "w"), ("p1", "2", "wallet", "w"),
        ("p2", "1", "wallet", "w"), ("p2", "2", "wallet", "w"),
    ]
    by_sku = trade_facts.refund_detail(records, names)
    assert rows(by_sku, "id", "refund_num") == [("p1", "1"), ("p2", "2")]


@pytest.mark.parametrize("job", ["request", "detail"])
def test_refund_joins_stream(spark, rows, folder, job):
    names = dictionary(spark, **REFUND_NAMES)

    def build(records):
        if job == "request":
            return trade_facts.order_refund(records, names)
        return trade_facts.refund_detail(records, names, by_sku=True)

    got = run(spark, folder, build(feed(spark, folder, refund_changes(), schema=schemas.CDC)))
    assert rows(got) == rows(build(changes(spark, refund_changes())))


def test_payment_summary_stream(spark, rows, folder, monkeypatch):
    real = stateful.keep_latest
    monkeypatch.setattr(stateful, "keep_latest", lambda df, key, version, tie: real(df, key, version, tie, 0))
    batch = order_rows(spark).select(
        F.col("id").alias("order_detail_id"), "user_id",
        F.col("create_time").alias("callback_time"), "row_op_ts",
    )
    data = [tuple(r) for r in batch.collect()]
    stream = trade_summary.payment_window(
        feed(spark, folder, data[:5], data[5:], schema=batch.schema)
    )
    want = rows(closed(trade_summary.payment_window(batch)))
    os.makedirs(f"{folder}/out")
    got = run_until(spark, folder, stream, len(want))
    assert rows(closed(got)) == want


TIES = [
    ("key", "string", ["b", "aa", "", None, "B", "aaaaaaaaaaaaaaaaaaaaaaab", "aaaaaaaaaaaaaaaaaaaaaaaa"]),
    ("key", "timestamp", ["2024-01-01 10:00:00.9", "2024-01-01 10:00:00.85", None, "2024-01-01 09:00:00"]),
    ("key", "long", [-5, 10, 9, None, -50, 10**18]),
    ("key", "double", [0.5, -1.5, None, float("nan"), 1e300]),
    ("key", "decimal(20,4)", ["1.5", "-10.25", "9", None]),
]


@pytest.mark.parametrize("name,kind,values", TIES, ids=[t[1] for t in TIES])
@pytest.mark.parametrize("job", ["visitors", "jumps"])
def test_equal_times_are_decided_as_in_batch(spark, rows, folder, job, name, kind, values):
    """Ties by text of any length, times with fractions, negative numbers and nulls."""
    rng = random.Random(7)
    order = [*values, *values]
    rng.shuffle(order)
    pages = [page(i, f"m{i % 2}", "2024-01-01 12:00:00", [None, "home"][i % 3 == 0], "home") for i in range(len(order))]

    def tied(df):
        each = spark.createDataFrame([(i, v if v is None else str(v)) for i, v in enumerate(order)], "event_id long, v string")
        return df.join(each, "event_id", "left").withColumn(name, F.col("v").cast(kind)).drop("v")

    build = traffic_facts.unique_visitors if job == "visitors" else (lambda df, tie: traffic_facts.user_jumps(df, 60_000, tie))
    tie = [name, "event_id"]
    got = run(spark, folder, build(tied(feed(spark, folder, pages, [LAST])), tie))
    want = build(tied(page_log(spark, pages)), tie)
    assert rows(no_last(got), "event_id") == rows(want, "event_id")
