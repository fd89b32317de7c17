"""Keep-first with a time-out, versions by time, snapshots, logs of changes, state from history."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import change, changes, ms
from millrace import schemas
from millrace.operators import cdc, routing
from millrace.operators.as_of import as_of_join
from millrace.operators.dedup import first_after_idle
from millrace.operators.lookups import ExpiringTable, dictionary_name
from millrace.plans import trade_summary
from millrace.session import shared_dir
from millrace.streaming import jobs, sinks, stateful

VERSIONS = "k string, at timestamp, version timestamp, what string"


@pytest.fixture
def folder(spark):
    return shared_dir(spark, "test")


def feed(spark, folder, *batches, schema=VERSIONS):
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/{n:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def run(spark, folder, stream):
    query = sinks.append_table(stream, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out"), query


def at(spark, *rows):
    """Rows of (key, second, version second, what)."""
    zero = ms("2024-01-01 00:00:00") // 1000
    shown = [(k, zero + s, zero + v, w) for k, s, v, w in rows]
    df = spark.createDataFrame(shown, "k string, s bigint, v bigint, what string")
    made = df.select("k", F.timestamp_seconds("s").alias("at"), F.timestamp_seconds("v").alias("version"), "what")
    return [tuple(r) for r in made.collect()]


def brute_first(rows, idle):
    """First row of each key by (second, version, what), and after more than ``idle`` seconds without one."""
    out, last = [], {}
    for k, s, v, w in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        if k not in last or s - last[k] > idle:
            out.append((k, w))
        last[k] = s
    return sorted(out)


def random_versions(seed, n=300):
    rng = random.Random(seed)
    # a third of the rows share a key; many share a second
    return [
        (rng.choice(["hot", "a", "b", "c", "d"] if i % 3 else ["hot"]), rng.randrange(200), rng.randrange(3), f"{i:04d}") for i in range(n)
    ]


@pytest.mark.parametrize("idle", [0, 3, 20])
def test_first_after_idle_equals_brute_force(spark, rows, idle):
    given = random_versions(idle)
    df = spark.createDataFrame(at(spark, *given), VERSIONS)
    got = first_after_idle(df, ["k"], "at", "version", idle * 1000, ["what"])
    assert rows(got, "k", "what") == brute_first(given, idle)


def test_keep_first_stream_equals_batch_whatever_the_order(spark, rows, folder):
    given = random_versions(7)
    ordered, rng = sorted(given, key=lambda r: r[1]), random.Random(3)
    batches = [ordered[i : i + 75] for i in range(0, len(ordered), 75)]
    for b in batches:
        rng.shuffle(b)
    far = [("last", 10**6, 0, "last")]
    stream = feed(spark, folder, *[at(spark, *b) for b in batches], at(spark, *far))
    got, _ = run(spark, folder, stateful.keep_first(stream, ["k"], "at", "version", 3000, ["what"]))
    assert rows(got.where("k <> 'last'"), "k", "what") == brute_first(given, 3)


def test_keep_first_forgets_after_the_time_out(spark, rows, folder):
    batches = [
        [("a", 0, 2, "second version"), ("a", 0, 1, "first")], [("a", 4, 0, "within")], [("b", 60, 0, "other")],
        [("a", 61, 0, "again")], [("c", 10**6, 0, "last")],
    ]
    stream = feed(spark, folder, *[at(spark, *b) for b in batches])
    got, query = run(spark, folder, stateful.keep_first(stream, ["k"], "at", "version", 5000, ["what"]))
    assert rows(got, "k", "what") == [("a", "again"), ("a", "first"), ("b", "other")]
    # only the row in the future, which no watermark has passed, is still in state
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    held = spark.read.format("statestore").option("path", f"{folder}/checkpoint").option("stateVarName", "stretches").load()
    assert held.select("key._key0").distinct().collect() == [("c",)]


def test_keep_first_arrival_passes_rows_on_at_once(spark, rows, folder):
    stream = feed(spark, folder, at(spark, ("a", 1, 2, "newer"), ("a", 1, 1, "older")), at(spark, ("a", 1, 0, "late"), ("b", 0, 0, "b")))
    kept = stateful.keep_first_arrival(stream, ["k"], "version", 3_600_000, ["what"])
    import os
    import time

    os.makedirs(f"{folder}/out")
    query = sinks.append_table(kept, f"{folder}/out", f"{folder}/checkpoint", {"processingTime": "0 seconds"})
    try:
        end = time.time() + 60
        while time.time() < end and spark.read.schema(kept.schema).parquet(f"{folder}/out").count() < 2:
            time.sleep(0.5)
    finally:
        query.stop()
    assert rows(spark.read.schema(kept.schema).parquet(f"{folder}/out"), "k", "what") == [("a", "older"), ("b", "b")]


def test_settled_versions_are_the_newest_within_the_delay(spark, rows, folder):
    batches = [
        [("a", 0, 1, "old"), ("b", 1, 1, "only")], [("a", 4, 5, "new"), ("a", 3, 5, "equal version")],
        [("a", 30, 0, "next")], [("z", 10**6, 0, "last")],
    ]
    stream = feed(spark, folder, *[at(spark, *b) for b in batches])
    got, _ = run(spark, folder, stateful.settle_latest(stream, ["k"], "at", "version", 5000, ["what"]))
    assert rows(got, "k", "what") == [("a", "new"), ("a", "next"), ("b", "only")]


def test_as_of_join_equals_brute_force(spark, rows):
    rng = random.Random(5)
    left = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(50)] if i % 9 == 0 else range(50))) for i in range(200)]
    right = [(rng.choice(["hot", "a", "b", None]), rng.choice([None, *range(50)]), rng.randrange(3), f"v{i}") for i in range(40)]
    got = as_of_join(
        spark.createDataFrame(left, "id int, k string, t bigint"),
        spark.createDataFrame(right, "k string, t bigint, tie int, name string").withColumn("found", F.struct("name")),
        ["k"], "t", "found", tie_break=["tie"], slice_ms=7,
    )
    want = []
    for i, k, t in left:
        fit = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        want.append((i, max(fit, key=lambda r: (r[1], r[2], r[3]))[3] if fit else None))
    assert rows(got.select("id", "found.name")) == sorted(want, key=repr)


def test_as_of_join_of_empty_sides(spark):
    left, right = "id int, k string, t bigint", "k string, t bigint, found struct<name: string>"
    one = spark.createDataFrame([(1, "a", 5)], left)
    none = spark.createDataFrame([], right)
    assert [tuple(r) for r in as_of_join(one, none, ["k"], "t", "found").collect()] == [(1, "a", 5, None)]
    some = spark.createDataFrame([("a", 1, ("x",))], right)
    assert as_of_join(spark.createDataFrame([], left), some, ["k"], "t", "found").collect() == []


def route(op, at_ms, sink="dim", columns="id,name", source="a"):
    image = (source, sink, columns, None, None)
    return (image if op in "ud" else None, image if op != "d" else None, op, at_ms)


def test_records_take_the_route_of_their_time(spark, rows, folder):
    history = spark.createDataFrame(
        [route("c", 2000), route("u", 5000, "other"), route("d", 8000, "other")], schemas.ROUTE_CHANGE
    )
    records = [change("a", "insert", {"id": str(t), "name": "x"}, ts=t) for t in range(1, 10)]
    records += [change("a", "delete", {"id": "3"}, ts=3), change("b", "insert", {"id": "1"}, ts=3), change("a", "insert", {"name": "x"}, ts=3)]
    routed = routing.route_by_time(changes(spark, records), routing.route_versions(history))
    want = [("dim", str(t)) for t in (2, 3, 4)] + [("other", str(t)) for t in (5, 6, 7)]
    assert rows(routed, "sink_table", "pk") == want
    # whatever the micro-batches
    stream = feed(spark, folder, records[:4], records[4:], schema=schemas.CDC)
    jobs.load_dimensions_by_time(
        stream, lambda: routing.route_versions(history), f"{folder}/table", f"{folder}/checkpoint"
    ).awaitTermination()
    assert rows(jobs.dimension_store(f"{folder}/table").read(spark), "sink_table", "pk") == want


def test_configuration_snapshot_then_feed(spark, rows):
    snapshot = spark.createDataFrame([("a", "dim_a", "id", None)], "source_table string, sink_table string, sink_columns string, sink_pk string")
    changes_ = spark.createDataFrame(
        [route("c", 1000, "old"), route("c", 900, "gone", source="b"), route("d", 950, "gone", source="b"), route("u", 3000, "new")],
        schemas.ROUTE_CHANGE,
    )
    got = routing.current_routes(routing.snapshot_then_feed(snapshot, changes_.where("op <> 'd'"), 2000))
    assert rows(got, "source_table", "sink_table") == [("a", "new")]


def snapshot_case():
    log = [
        change("t", "insert", {"id": "1", "name": "before"}, ts=5, xid=1), change("t", "insert", {"id": "9", "name": "gone"}, ts=6, xid=1),
        change("t", "update", {"id": "1", "name": "same instant, before"}, ts=10, xid=1),
        change("t", "update", {"id": "1", "name": "same instant, after"}, ts=10, xid=3),
        change("t", "insert", {"id": "3", "name": "three"}, ts=12, xid=1), change("other", "insert", {"id": "7"}, ts=12),
        change("t", "delete", {"id": "2"}, ts=13, xid=1),
    ]
    return log, [("1", "one"), ("2", "two"), ("4", None)], (10, 2)


def test_snapshot_then_changes_has_no_gap_and_no_repeat(spark, rows):
    log, table, position = snapshot_case()
    snapshot = spark.createDataFrame(table, "id string, name string")
    feed_ = cdc.snapshot_then_changes(snapshot, changes(spark, log), "t", position)
    got = rows(feed_.select("type", "xid", cdc.data("id"), cdc.data("name")))
    assert got == sorted([
        ("bootstrap-insert", 2, "1", "one"), ("bootstrap-insert", 2, "2", "two"), ("bootstrap-insert", 2, "4", None),
        ("update", 3, "1", "same instant, after"), ("insert", 1, "3", "three"), ("delete", 1, "2", None),
    ], key=repr)


def test_snapshot_is_read_once_and_a_restart_goes_on(spark, rows, folder):
    log, table, position = snapshot_case()
    snapshot = spark.createDataFrame(table, "id string, name string")
    store = jobs.snapshot_store(f"{folder}/table", fold_every=2)

    def start(given, *batches):
        for n, batch in batches:
            spark.createDataFrame(batch, schemas.CDC).coalesce(1).write.mode("append").parquet(f"{folder}/in/{n:03d}")
        stream = spark.readStream.schema(schemas.CDC).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
        jobs.load_snapshot(store, given, stream, "t", position, f"{folder}/checkpoint").awaitTermination()
        latest = store.read(spark).where("type <> 'delete'")
        return rows(latest.select("pk", cdc.data("name")))

    assert start(snapshot, (0, log[:3]), (1, log[3:4])) == [("1", "same instant, after"), ("2", "two"), ("4", None)]
    # a table that has moved on since is not read again
    moved = spark.createDataFrame([("5", "later")], "id string, name string")
    assert start(moved, (2, log[4:])) == [("1", "same instant, after"), ("3", "three"), ("4", None)]


SIDES = ("l int, lk string, lt timestamp", "r int, rk string, rt timestamp")


def test_left_join_answers_at_once_and_takes_back(spark, rows, folder):
    def rows_of(name, schema, *batches):
        made = []
        for b in batches:
            df = spark.createDataFrame(b, schema.replace("timestamp", "bigint"))
            time = schema.split()[-2]
            made.append([tuple(r) for r in df.withColumn(time, F.timestamp_seconds(time)).collect()])
        return made

    left = rows_of("l", SIDES[0], [(1, "a", 1), (2, "b", 1), (3, None, 1)], [(4, "a", 5)], [(9, "z", 10**6)], [(6, "a", 10**6)])
    right = rows_of("r", SIDES[1], [(10, "x", 1)], [(11, "a", 4), (12, "a", 5), (13, None, 5)], [(99, "y", 10**6)], [(14, "q", 10**6)])
    streams = [feed(spark, f"{folder}/{n}", *b, schema=s) for n, (b, s) in enumerate(zip((left, right), SIDES, strict=True))]
    log = stateful.left_join_changes(*streams, "lk", "rk", "lt", "rt", keep_ms=60_000)
    sinks.append_changes(log, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    written = spark.read.parquet(f"{folder}/out")
    first = written.where("batch_id = 0").select("op", "l", "r")
    # unmatched rows are out before their match arrives
    assert rows(first) == [("+", 1, None), ("+", 2, None), ("+", 3, None)]
    assert ("-", 1, None) in rows(written.select("op", "l", "r"))
    folded = stateful.fold_changes(written.drop("batch_id"))
    # the last row of key a comes when the others are long forgotten
    assert rows(folded.select("l", "r")) == sorted(
        [(1, 11), (1, 12), (2, None), (3, None), (4, 11), (4, 12), (6, None), (9, None)], key=repr
    )


def test_change_feed_of_a_keyed_table(spark, rows, folder):
    table = sinks.KeyedTable(folder, ["k"], ["v"], "k string, v int, gone boolean", fold_every=2)

    def batch(*values):
        return spark.createDataFrame(list(values), "k string, v int, gone boolean")

    def shown(df):
        return rows(df.select("batch_id", "op", "before.v", F.col("after.v").alias("w"), F.coalesce("after.k", "before.k").alias("key")))

    assert table.changes(spark).collect() == []
    table.write(batch(("a", 1, False), ("b", 1, False), ("c", 1, True)), 0)
    table.write(batch(("a", 2, False), ("b", 0, False)), 1)  # an older version changes nothing
    table.write(batch(("a", 2, False), ("b", 3, True)), 2)
    table.write(batch(("b", 4, False)), 3)
    want = [
        (0, "insert", None, 1, "a"), (0, "insert", None, 1, "b"), (1, "update", 1, 2, "a"), (2, "delete", 1, None, "b"),
        (3, "insert", None, 4, "b"),
    ]
    assert shown(table.changes(spark, deleted="gone")) == sorted(want, key=repr)
    assert shown(table.changes(spark, 1, "gone")) == sorted(want[3:], key=repr)
    seen = []
    done = table.changes_since(spark, lambda df, n: seen.append((n, df.count())), 1, "gone")
    assert (done, seen) == (3, [(3, 2)])
    assert table.changes_since(spark, lambda df, n: seen.append(n), done, "gone") == 3 and len(seen) == 1


def test_a_stream_starts_with_the_users_of_a_batch(spark, rows, folder):
    schema = "order_detail_id string, user_id string, callback_time string, row_op_ts timestamp"

    def payments(*given):
        df = spark.createDataFrame([(str(i), u, t) for i, (u, t) in enumerate(given)], "i string, u string, t string")
        return df.select("i", "u", "t", F.col("t").cast("timestamp").alias("ts")).toDF(*[c.split()[0] for c in schema.split(", ")])

    before = payments(("a", "2024-01-01 10:00:00"), ("b", "2024-01-02 10:00:00"))
    after = payments(("a", "2024-01-03 10:00:00"), ("c", "2024-01-03 10:00:01"), ("c", "2024-01-04 10:00:00"), ("z", "2030-01-01 00:00:00"))
    stream = feed(spark, folder, [tuple(r) for r in after.collect()], schema=schema)
    history = trade_summary.payment_history(before)
    got, _ = run(spark, folder, trade_summary.payment_window(stream, settle_ms=1000, history=history).drop("ts"))
    assert rows(got, "stt", "unique_users", "new_users") == [("2024-01-03 10:00:00", 2, 1), ("2024-01-04 10:00:00", 1, 0)]


def test_folding_removes_what_is_covered(spark, rows, folder):
    table = sinks.KeyedTable(folder, ["k"], ["v"], "k string, v int", fold_every=3, keep=2)
    for n in range(14):
        table.write(spark.createDataFrame([(f"k{n % 4}", n)], "k string, v int"), n)
        assert max(rows(table.read(spark), "v")) == (n,)
    assert rows(table.read(spark)) == [("k0", 12), ("k1", 13), ("k2", 10), ("k3", 11)]
    # snapshots after batches 8 and 11; batches up to 8 are covered by the older one
    assert table._finished(spark, "snapshots") == [8, 11]
    assert table._finished(spark, "batches") == [9, 10, 11, 12, 13]
    assert rows(table.changes(spark, 11).select("batch_id", "op", "after.v")) == [(12, "update", 12), (13, "update", 13)]
    assert table.changes(spark, 8).count() == 5
    with pytest.raises(ValueError, match="removed"):
        table.changes(spark, 5)


def test_a_dictionary_is_read_again_when_it_has_expired(spark, rows, folder):
    now, names, readings = [0.0], {"1": "old"}, []

    def read():
        readings.append(now[0])
        return spark.createDataFrame(list(names.items()), "dic_code string, dic_name string")

    table = ExpiringTable(read, 10, lambda: now[0])

    def batch(n):
        spark.createDataFrame([(n, "1")], "id int, code string").coalesce(1).write.parquet(f"{folder}/in/{n:03d}")
        stream = spark.readStream.schema("id int, code string").parquet(f"{folder}/in/*")
        jobs.append_enriched(
            stream, lambda b, t: dictionary_name(b, t, "code", "name"), table, f"{folder}/out", f"{folder}/checkpoint"
        ).awaitTermination()

    batch(0)
    names["1"], now[0] = "new", 9.0
    batch(1)  # not expired yet
    now[0] = 10.0
    batch(2)
    assert rows(spark.read.parquet(f"{folder}/out/*"), "id", "name") == [(0, "old"), (1, "old"), (2, "new")]
    assert readings == [0.0, 10.0]
