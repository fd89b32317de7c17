"""State of many keys, kept by bucket."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from millrace import codes
from millrace.streaming import sinks, stateful

DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_state_grows_with_buckets_not_with_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(codes, "STATE_BUCKETS", 4)
    rows = [(i % 300, i, DAY + timedelta(seconds=i)) for i in range(600)]
    rows += [(None, 600, DAY), (None, 601, DAY + timedelta(seconds=1))]
    given = spark.createDataFrame(rows, "k long, n long, t timestamp")
    given.where("n < 300").write.parquet(f"{tmp_path}/in/0")
    given.where("n >= 300").write.parquet(f"{tmp_path}/in/1")
    stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", 4).parquet(f"{tmp_path}/in/*")
    no_version = stream.withColumn("v", F.lit(None).cast("timestamp"))
    kept = stateful.keep_first(no_version, ["k"], "t", "v", 3_600_000, ("n",))
    query = sinks.append_table(kept, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    found = spark.read.schema(kept.schema).parquet(f"{tmp_path}/out")
    # all rows of a key lie within the idle time; rows the watermark has not passed yet stay
    assert {(r.k, r.n) for r in found.collect()} == {(i, i) for i in range(300)} | {(None, 600)}
    # three values and a timer for each bucket at most, where each key had its own
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 8 * 4
