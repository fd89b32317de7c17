"""Rows in state carry each column once, and versions of positions are settled once per stream."""

from datetime import datetime, timezone
from decimal import Decimal

import pyspark.sql.functions as F

from millrace.plans import trade_summary
from millrace.session import shared_dir
from millrace.sources import sample
from millrace.streaming import processors, sinks, stateful

DETAIL = (
    "id string, sku_id string, sku_num string, order_price string, split_total_amount string, split_activity_amount string, "
    "split_coupon_amount string, user_id string, a_long_name_that_nobody_reads string, create_time string, row_op_ts timestamp"
)
T = datetime(2024, 1, 1, tzinfo=timezone.utc)


def details(spark, tmp_path, *rows):
    spark.createDataFrame(rows, DETAIL).coalesce(1).write.parquet(f"{tmp_path}/in")
    return spark.readStream.schema(DETAIL).parquet(f"{tmp_path}/in")


def test_order_window_settles_versions_once(spark, tmp_path):
    rows = details(spark, tmp_path, ("1", "7", "2", "3.5", "7", None, None, "u", "text", "2024-01-01 00:00:01", T))
    plan = trade_summary.order_window(rows, settle_ms=1000)._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithState") == 2  # versions, first visits


def test_a_column_travels_once(spark, tmp_path, monkeypatch):
    seen = []
    rows = details(spark, tmp_path, ("1", "7", "2", "3.5", "7", None, None, "u", "text", "2024-01-01 00:00:01", T))
    real = stateful._bucketed
    monkeypatch.setattr(stateful, "_bucketed", lambda given: seen.append(given) or real(given))
    stateful.settle_latest(rows, ["id"], "row_op_ts", "row_op_ts", 1000, trade_summary.DETAIL_TIE_BREAK)
    (given,) = seen
    query = given.select("key", "tie", "payload").writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(
        availableNow=True).start(f"{tmp_path}/out", "parquet")
    query.awaitTermination()
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    texts = row.key + row.tie + row.payload
    assert "a_long_name" not in texts and texts.count('"3.5"') == 1 and "2024-01-01T" not in texts


def test_types_nulls_and_odd_names_come_back(spark, tmp_path):
    schema = "`k.` bigint, d double, n decimal(10,3), t timestamp, `v w` timestamp, s struct<a: string, b: int>, x string"
    rows = [
        (1, float("nan"), Decimal("1.250"), T, None, ("q", None), None), (None, None, None, T, T, None, "é\"\n"),
        (2, -0.5, Decimal("0.001"), T.replace(microsecond=5000), T.replace(microsecond=7), (None, 3), ""),
    ]
    given = spark.createDataFrame(rows, schema).withColumnRenamed("k.", "k").withColumnRenamed("v w", "v")
    given.coalesce(1).write.parquet(f"{tmp_path}/in/0")
    last = given.limit(1).withColumns({"k": F.lit(9).cast("long"), "t": F.expr("t + INTERVAL 100 DAYS")})
    last.coalesce(1).write.parquet(f"{tmp_path}/in/1")
    for idle in (1000, 3_600_000):  # by key, by bucket
        stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        for n, kept in enumerate([stateful.keep_first(stream, ["k"], "t", "v", idle, ("d", "n")),
                                  stateful.settle_latest(stream, ["k"], "t", "v", idle, ("d", "n"))]):
            at = f"{tmp_path}/{idle}-{n}"
            assert kept.columns == given.columns
            sinks.append_table(kept, f"{at}/out", f"{at}/c").awaitTermination()
            found = spark.read.schema(given.schema).parquet(f"{at}/out").collect()
            assert sorted(map(repr, found)) == sorted(map(repr, given.collect()))


def test_packed_state_comes_back():
    held = {"a": ([(1, 2, "tie", "text")], None), "b": (None, {})}
    assert processors._unpacked(processors._packed(held)) == held and processors._unpacked(processors._packed({})) == {}


def test_a_feed_stores_its_rows_once(spark, monkeypatch):
    root = shared_dir(spark, "once")
    monkeypatch.setattr(sample, "shared_dir", lambda *_: root)
    sample.in_batches(spark.range(50).withColumnRenamed("id", "n"), "n", 2)
    assert spark.read.option("recursiveFileLookup", "true").parquet(root).count() == 50
