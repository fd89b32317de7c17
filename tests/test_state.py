"""First visits, bounces, deduplication, windows: edge rows and brute force."""

import random
import re
from datetime import date

from pyspark.sql import functions as F

from helpers import page, page_log
from millrace.functions.times import millis_to_time
from millrace.operators import firsts, windows
from millrace.operators.bounce import bounces
from millrace.operators.dedup import dedup_first, dedup_latest
from millrace.plans import trade_summary, traffic_facts, traffic_summary, user_summary


def test_unique_visitor_is_first_by_event_time(spark, rows):
    log = page_log(
        spark,
        [
            page(1, "a", "2024-01-01 12:00:00"),
            page(2, "a", "2024-01-01 09:00:00"),  # arrives later, happened first
            page(3, "a", "2024-01-01 23:59:59"),
            page(4, "a", "2024-01-02 00:00:00"),
            page(5, "b", "2024-01-01 09:00:00"),
            page(6, None, "2024-01-01 09:00:00"),
            page(8, "c", "2024-01-01 09:00:00"),
            page(7, "c", "2024-01-01 09:00:00"),  # same time: the smaller id
        ],
    )
    assert rows(traffic_facts.unique_visitors(log, ["event_id"]), "event_id") == [
        (2,), (4,), (5,), (7,),
    ]


def test_bounce_edges(spark, rows):
    log = page_log(
        spark,
        [
            # followed in time by a page with a previous page: no bounce
            page(1, "a", "2024-01-01 00:00:00", None),
            page(2, "a", "2024-01-01 00:00:09.999"),
            # followed exactly at the deadline: bounce
            page(3, "b", "2024-01-01 00:00:00", None),
            page(4, "b", "2024-01-01 00:00:10"),
            # followed by another opening page: both bounce
            page(5, "c", "2024-01-01 00:00:00", None),
            page(6, "c", "2024-01-01 00:00:01", None),
            # same time, order by id: 7 is followed by 8
            page(8, "d", "2024-01-01 00:00:00"),
            page(7, "d", "2024-01-01 00:00:00", None),
            page(9, None, "2024-01-01 00:00:00", None),
        ],
    )
    assert rows(traffic_facts.user_jumps(log, tie_break=["event_id"]), "event_id") == [
        (3,), (5,), (6,),
    ]


def brute_bounces(events, within):
    found = []
    for key in {e[1] for e in events}:
        mine = sorted((e for e in events if e[1] == key), key=lambda e: (e[2], e[0]))
        for here, after in zip(mine, mine[1:] + [None]):
            if here[3] is None and (
                after is None or after[2] - here[2] >= within or after[3] is None
            ):
                found.append((here[0],))
    return sorted(found, key=repr)


def test_bounces_equal_brute_force_with_one_hot_key(spark, rows):
    rng = random.Random(7)
    within = 50
    events = [
        # a third of the rows has one key; times around many slice borders
        (i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}",
         rng.randrange(0, within * 32 * 6) - within * 32, rng.choice([None, "p", "p"]))
        for i in range(6000)
    ]
    df = spark.createDataFrame(events, "id int, k string, ms bigint, prev string")
    got = bounces(df, F.col("k"), F.col("ms"), F.col("prev"), within, ["id"])
    assert rows(got, "id") == brute_bounces(events, within)


def test_bounce_groups_are_time_slices_not_keys(spark):
    df = spark.createDataFrame(
        [(i, "hot", i * 10, None) for i in range(20_000)], "id int, k string, ms bigint, prev string"
    )
    out = bounces(df, F.col("k"), F.col("ms"), F.col("prev"), 100, ["id"])
    assert out.count() == 20_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # partitioned by the key and the start of the slice
    assert re.match(r"_key#\d+, _w0#\d+L, _ms#", plan.split("windowspecdefinition(")[1])


def login(event_id, uid, time, last=None):
    return page(event_id, "m", time, last, uid=uid)


def test_returning_users_after_more_than_eight_days(spark, rows):
    log = page_log(
        spark,
        [
            login(1, "a", "2024-01-01 10:00:00"),
            login(2, "a", "2024-01-09 23:00:00", "login"),  # eight days: not back
            login(3, "a", "2024-01-18 00:30:00"),           # nine days: back
            login(4, "a", "2024-01-18 00:30:01"),           # same day again
            login(5, "a", "2024-01-19 00:00:00", "home"),   # no login, a row of zeros
            login(6, None, "2024-01-25 00:00:00"),          # unknown user: nothing
            login(7, "b", "2024-01-18 00:30:05"),
        ],
    )
    out = user_summary.user_login_window(log, "1 day")
    assert rows(out, "stt", "back_ct", "uu_ct") == [
        ("2024-01-01 00:00:00", 0, 1),
        ("2024-01-09 00:00:00", 0, 1),
        ("2024-01-18 00:00:00", 1, 2),
        ("2024-01-19 00:00:00", 0, 0),
    ]


def test_history_of_visits(spark, rows):
    times = ["2024-01-01 01:00:00", "2024-01-01 00:30:00", "2024-01-03 00:00:00"]
    df = spark.createDataFrame([("u", t) for t in times], "k string, t string").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    visits = firsts.with_visit_history(firsts.daily_visits(df, ["k"], "t"), "k")
    assert rows(visits, "visit_date", "gap_days") == [
        (date(2024, 1, 1), None), (date(2024, 1, 3), 2),
    ]


VERSIONS = [
    ("1", "2024-01-01 10:20:47", "a"),
    ("1", "2024-01-01 10:20:47.300", "b"),
    ("1", "2024-01-01 10:20:46.900", "c"),
    ("2", "2024-01-01 00:00:00", "x"),
    ("2", "2024-01-01 00:00:00", "y"),
]


def test_dedup_by_version(spark, rows):
    df = spark.createDataFrame(VERSIONS, "id string, v string, what string").withColumn(
        "v", F.col("v").cast("timestamp")
    )
    assert rows(dedup_latest(df, ["id"], "v", ["what"]), "id", "what") == [("1", "b"), ("2", "y")]
    assert rows(dedup_first(df, ["id"], "v", ["what"]), "id", "what") == [("1", "c"), ("2", "x")]


def test_copies_of_a_key_are_dropped_before_the_shuffle(spark):
    df = spark.createDataFrame(VERSIONS, "id string, v string, what string")
    plan = dedup_latest(df, ["id"], "v", ["what"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning(id")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_window_borders(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:09.999",), ("2024-01-01 00:00:10",), (None,)], "t string"
    ).select(F.col("t").cast("timestamp").alias("t"))
    out = windows.tumble(df, "t", [F.count(F.lit(1)).alias("n")])
    assert rows(out) == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", 1),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 1),
    ]


def detail(number, order, user, time, province="1", sku="1", amount="10.00", num="2",
           price="5.50", activity=None, version="2024-01-01 00:00:00"):
    return (number, order, user, sku, num, price, province, time, activity, None, amount, version)


DETAIL = (
    "id string, order_id string, user_id string, sku_id string, sku_num string, "
    "order_price string, province_id string, create_time string, split_activity_amount string, "
    "split_coupon_amount string, split_total_amount string, row_op_ts string"
)


def details(spark, rows_):
    return spark.createDataFrame(rows_, DETAIL).withColumn(
        "row_op_ts", F.col("row_op_ts").cast("timestamp")
    )


def test_orders_per_window(spark, rows):
    df = details(
        spark,
        [
            detail("1", "o1", "u", "2024-01-01 10:00:00", activity="1.25"),
            detail("1", "o1", "u", "2024-01-01 10:00:00", version="2023-12-31 00:00:00", num="9"),
            detail("2", "o1", "u", "2024-01-01 10:00:03"),
            detail("3", "o2", "u", "2024-01-02 10:00:00"),
            # a second order on a later day is not a further unique user
            detail("4", "o3", "u", "2024-01-02 10:00:20"),
            detail("5", "o4", "w", "2024-01-02 10:00:21"),
        ],
    )
    out = trade_summary.order_window(df)
    assert rows(out.drop("ts", "edt")) == [
        ("2024-01-01 10:00:00", 1, 1, 1.25, 0.0, 22.0),
        ("2024-01-02 10:00:00", 1, 0, 0.0, 0.0, 11.0),
        ("2024-01-02 10:00:20", 1, 1, 0.0, 0.0, 22.0),
    ]


def test_distinct_orders_per_window_and_missing_province(spark, rows):
    df = details(
        spark,
        [
            detail("1", "o1", "u", "2024-01-01 10:00:00"),
            detail("2", "o1", "u", "2024-01-01 10:00:01"),
            detail("3", "o1", "u", "2024-01-01 10:00:11"),
            detail("4", "o2", "u", "2024-01-01 10:00:02", province="9"),
        ],
    )
    provinces = spark.createDataFrame([("1", "north")], "id string, name string")
    out = trade_summary.province_order_window(df, provinces)
    assert rows(out, "stt", "province_id", "province_name", "order_count", "order_amount") == [
        ("2024-01-01 10:00:00", "1", "north", 1, 20.0),
        ("2024-01-01 10:00:00", "9", None, 1, 10.0),
        ("2024-01-01 10:00:10", "1", "north", 1, 10.0),
    ]


def test_product_names_survive_misses(spark, rows):
    df = details(
        spark,
        [
            detail("1", "o1", "u", "2024-01-01 10:00:00", sku="s1"),
            detail("2", "o2", "u", "2024-01-01 10:00:01", sku="missing"),
            detail("3", "o3", "u", "2024-01-01 10:00:01", sku="missing too"),
        ],
    )

    def dim(columns, *values):
        return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c in columns.split()))

    out = trade_summary.user_spu_order_window(
        df,
        dim("id spu_id tm_id category3_id", ("s1", "p", "t", "c3")),
        dim("id spu_name", ("p", "P")),
        dim("id tm_name", ("t", "T")),
        dim("id name category2_id", ("c3", "C3", "c2")),
        dim("id name category1_id", ("c2", "C2", "c1")),
        dim("id name", ("c1", "C1")),
    )
    assert rows(out, "spu_name", "trademark_name", "category1_name", "order_count") == sorted(
        [("P", "T", "C1", 1), (None, None, None, 2)], key=repr
    )
    assert len(out.columns) == 16


def test_new_and_unique_payers(spark, rows):
    def pay(number, user, at, version="2024-01-01 00:00:00"):
        return (number, user, at, version)

    df = spark.createDataFrame(
        [
            pay("1", "u", "2024-01-01 10:00:00"),
            pay("1", "u", "2024-01-01 10:00:00", "2024-01-01 00:00:01"),
            pay("2", "u", "2024-01-01 10:00:30"),
            pay("3", "u", "2024-01-02 10:00:00"),
            pay("4", "w", "2024-01-02 10:00:05"),
        ],
        "order_detail_id string, user_id string, callback_time string, row_op_ts string",
    ).withColumn("row_op_ts", F.col("row_op_ts").cast("timestamp"))
    assert rows(trade_summary.payment_window(df), "stt", "unique_users", "new_users") == [
        ("2024-01-01 10:00:00", 1, 1), ("2024-01-02 10:00:00", 2, 1),
    ]


def test_keywords_need_a_search_and_words(spark, rows):
    def searched(number, item, last="search", kind="keyword"):
        return page(number, "m", "2024-01-01 00:00:00", last, item=item, item_type=kind)

    log = page_log(
        spark,
        [
            searched(1, "Red Shoe, red!"),
            searched(2, "--"),
            searched(3, None),
            searched(4, "red", last="home"),
            searched(5, "red", kind="sku_id"),
            searched(6, "手机 64g"),
        ],
    )
    assert rows(traffic_summary.keyword_window(log), "source", "keyword", "keyword_count") == sorted(
        [("search", "red", 2), ("search", "shoe", 1), ("search", "手机", 1), ("search", "64g", 1)],
        key=repr,
    )


def test_traffic_measures_treat_missing_duration_as_zero(spark, rows):
    log = page_log(
        spark,
        [
            page(1, "a", "2024-01-01 00:00:00", None, during=None),
            page(2, "a", "2024-01-01 00:00:05", during=7),
        ],
    )
    out = traffic_summary.traffic_dims_window(
        log,
        traffic_facts.unique_visitors(log, ["event_id"]),
        traffic_facts.user_jumps(log, tie_break=["event_id"]),
    )
    assert rows(out, "uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct") == [(1, 1, 2, 7, 0)]


def test_no_window_runs_in_one_partition(spark):
    log = page_log(spark, [page(1, "a", "2024-01-01 00:00:00", None, uid="u")])
    df = details(spark, [detail("1", "o", "u", "2024-01-01 00:00:00")])
    for out in (
        user_summary.user_login_window(log),
        traffic_summary.page_uv_window(log),
        trade_summary.order_window(df),
        traffic_facts.user_jumps(log),
    ):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_millis_round_trip(spark, rows):
    df = spark.createDataFrame([(1704067207179,)], "ms bigint")
    assert rows(df.select(F.unix_millis(millis_to_time(F.col("ms"))))) == [(1704067207179,)]


def test_sketches_of_slots_roll_up_to_days(spark):
    from millrace.operators import windows

    day = "timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 86400)"
    df = spark.range(40_000).selectExpr(f"{day} AS t", "id % 7000 AS user", "IF(id % 3 = 0, 'a', 'b') AS k", "CAST(NULL AS BIGINT) AS gone")
    sketches = windows.distinct_sketches(df, "t", "user", "10 seconds", ["k"])
    exact = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("user").alias("n")).collect()}
    for size in ("1 hour", "1 day"):
        got = windows.roll_up_distinct(sketches, "users", size, ["k"]).collect()
        assert len(got) == (2 if size == "1 day" else 24)
    assert all(abs(r.users - exact[r.k]) < 0.05 * exact[r.k] for r in got)
    nothing = windows.roll_up_distinct(windows.distinct_sketches(df, "t", "gone"), "users", "1 day").collect()
    assert [r.users for r in nothing] == [0]
    assert windows.roll_up_distinct(windows.distinct_sketches(df.limit(0), "t", "user"), "users", "1 day").collect() == []
