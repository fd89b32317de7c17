"""Slots of visits that the watermark passes in their midst."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.windows import tumble, with_event_time
from millrace.streaming import sinks, stateful


@pytest.mark.parametrize("passed", [5000, 9999])
@pytest.mark.parametrize("form", ["daily_visits", "visit_flags"])
def test_a_slot_may_end_long_after_the_watermark_has_passed_its_first_row(spark, tmp_path, form, passed):
    # the watermark of the first batch lies 2 seconds behind its newest row, in the slot of "a"
    batches = [[("a", 1000), ("b", passed + 2000)], [("a", 9999), ("c", 60_000)], [("last", 10**9)]]
    for n, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, "k string, ms bigint").select("k", F.timestamp_millis("ms").alias("at"))
        rows.coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    if form == "daily_visits":
        visits = stateful.daily_visits(stream, ["k"], "at")
        time = "first_time"
    else:
        visits = stateful.visit_flags(with_event_time(stream, "at"), "k", "at")
        time = "event_time"
    counted = tumble(visits, time, [F.count(F.lit(1)).alias("n")])
    sinks.append_table(counted, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    found = {r.stt[-8:]: r.n for r in spark.read.schema(counted.schema).parquet(f"{tmp_path}/out").collect()}
    assert found == ({"00:00:00": 2, "00:01:00": 1} if passed == 5000 else {"00:00:00": 1, "00:00:10": 1, "00:01:00": 1})
