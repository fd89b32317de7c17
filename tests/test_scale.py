"""Work that must not grow: shuffles of order facts, stores of stream joins, files of feeds."""

import os
from datetime import date

import pytest
from helpers import change, changes

from checks.registry import QUERIES
from millrace.plans import trade_facts
from millrace.sources import sample

LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
)
ORDER = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
)


@pytest.fixture
def tables(spark, tmp_path):
    day = date(1995, 3, 1)
    lines = [
        (1, 7, 1, 1, 2.0, 10.0, 0.1, 0.02, "A", "F", day), (1, 7, 1, 1, 3.0, 12.0, 0.1, 0.02, "R", "F", date(1995, 4, 1)),
        (1, 8, 2, 2, 1.0, 20.0, 0.1, 0.02, "A", "F", day), (2, 9, 3, 1, 1.0, 30.0, 0.1, 0.02, "N", "F", day),
        (None, 9, 1, 1, 1.0, 30.0, 0.1, 0.02, "A", "F", day), (3, 9, 4, 1, 1.0, 30.0, 0.1, 0.02, "A", "F", day),
    ]
    orders = [(1, 5, "F", 30.0, day, "1-URGENT"), (2, 5, "O", 30.0, day, "2-HIGH")]
    spark.createDataFrame(lines, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, ORDER).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5, 3)], "c_custkey bigint, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def plan_of(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_of_positions_are_shuffled_once(spark, tables, rows):
    wide = QUERIES["trade_order_wide"](spark, tables)
    found = rows(wide, "id", "order_id", "sku_num", "type", "activity_id", "coupon_id", "split_activity_amount", "row_op_ts")
    assert found == sorted([
        ("11", "1", "3", "insert", None, "4", None, "1995-04-01 00:00:01"),
        ("11", "1", "3", "update", None, "4", None, "1995-04-01 00:00:01"),
        ("12", "1", "1", "insert", "2", None, "2.0000", "1995-03-01 00:00:01"),
        ("12", "1", "1", "update", "2", None, "2.0000", "1995-03-01 00:10:01"),
    ], key=repr)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(spark, QUERIES["trade_order_wide"](spark, tables))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet [l_") == 1


def test_facts_are_not_shuffled_by_the_codes_of_the_dictionary(spark):
    records = changes(spark, [change("cart_info", "insert", {"id": "1", "source_type": "2401"})])
    plan = plan_of(spark, trade_facts.cart_add(records, sample.dictionary(spark)))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_join_of_streams_keeps_one_store_per_task(spark, tmp_path):
    schema = "k bigint, at timestamp"
    spark.sql("SELECT 1L AS k, timestamp_seconds(10) AS at").write.parquet(f"{tmp_path}/in")
    left, right = (spark.readStream.schema(schema).parquet(f"{tmp_path}/in").withWatermark("at", "1 second") for _ in "ab")
    joined = left.alias("l").join(right.alias("r"), "k").selectExpr("k")
    query = joined.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(
        f"{tmp_path}/out", "parquet"
    )
    query.awaitTermination()
    (state,) = query.recentProgress[0].stateOperators
    assert state.numStateStoreInstances == state.numShufflePartitions


def test_ranges_of_a_feed_do_not_mix(spark, tmp_path):
    rows = spark.sql("SELECT id AS n FROM range(7)")  # fewer rows in a range than files
    stream = sample.in_batches(rows, "n", 2)
    seen = []
    stream.writeStream.foreachBatch(lambda batch, _: seen.append(sorted(r.n for r in batch.collect()))).option(
        "checkpointLocation", f"{tmp_path}/c"
    ).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 2 and max(seen[0]) < min(seen[1]) and sorted(sum(seen, [])) == list(range(7))


def test_a_large_feed_is_written_by_as_many_tasks_as_there_are_cores(spark, monkeypatch):
    monkeypatch.setattr(sample, "ROWS_PER_FILE", 10)
    sample.in_batches(spark.range(1000).withColumnRenamed("id", "n"), "n", 2)
    root = spark.conf.get("spark.checkpoint.dir")
    newest = max((f"{root}/{f}" for f in os.listdir(root) if f.startswith("feed-")), key=os.path.getmtime)
    for part in ("000", "001"):
        names = [f for f in os.listdir(f"{newest}/feed/{part}") if f.endswith(".parquet")]
        assert len(names) == spark.sparkContext.defaultParallelism
