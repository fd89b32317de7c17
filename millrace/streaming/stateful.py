"""Stateful operators on streams, with the same results as their batch forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import codes
from millrace.functions.times import millis_to_time
from millrace.operators.bounce import SLICE_FACTOR
from millrace.operators.windows import with_event_time
from millrace.streaming import processors
from millrace.streaming.processors import (
    Bounces,
    Buckets,
    ByKey,
    FirstRow,
    KeepFirst,
    KeepFirstArrival,
    KeepLatest,
    RetractingLeftJoin,
    SettleLatest,
    VisitFlags,
)

# executors get the processors themselves and need not have this package installed
cloudpickle.register_pickle_by_value(processors)

#: Text form of rows in state; keeps microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _numbered(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c).alias(str(i)) for i, c in enumerate(columns)])


def _payload(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row as text; columns go by their numbers, as their names would be most of it."""
    shown = df.columns if columns is None else columns
    return (F.to_json(_numbered(shown), _JSON) if shown else F.lit("{}")).alias("payload")


def _parsed(text: str, like: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> dict[str, Column]:
    """The columns of a text made of them, with the types they have in ``like``."""
    names = names or [str(i) for i in range(len(columns))]
    schema = T.StructType([T.StructField(n, like.select(c).schema[0].dataType) for n, c in zip(names, columns)])
    return {c: F.from_json(text, schema, _JSON)[n] for n, c in zip(names, columns)}


def _unpack(rows: DataFrame, like: DataFrame) -> DataFrame:
    found = _parsed("payload", like, like.columns)
    return rows.select(*[found[c].alias(c) for c in like.columns])


def _tie_names(df: DataFrame, columns: Sequence[str]) -> list[str]:
    floating = [isinstance(df.select(c).schema[0].dataType, (T.FloatType, T.DoubleType)) for c in columns]
    return [f"{i}f" if f else f"{i}v" for i, f in enumerate(floating)]


def _tie(df: DataFrame, columns: Sequence[str]) -> Column:
    """Tie-break values with their types, as a JSON object in the order of ``columns``."""
    parts = [F.col(c).alias(n) for c, n in zip(columns, _tie_names(df, columns))]
    if not parts:
        return F.lit("{}").alias("tie")
    return F.to_json(F.struct(*parts), {**_JSON, "ignoreNullFields": "false"}).alias("tie")


def _key(*columns: str) -> Column:
    """Key values as one text; a null key is a key."""
    return F.to_json(_numbered(columns), {**_JSON, "ignoreNullFields": "false"}).alias("key")


def _bucketed(rows: DataFrame) -> DataFrame:
    """Rows that begin with their ``key``, and the bucket that key is kept in before it."""
    return rows.select(F.pmod(F.xxhash64("key"), F.lit(codes.STATE_BUCKETS)).cast("int").alias("bucket"), *rows.columns)


def _day_end(time: Column) -> Column:
    """Last millisecond of the day ``time`` lies in."""
    return F.unix_millis(F.date_add(F.to_date(time), 1).cast("timestamp")) - 1


def _first_rows(
    rows: DataFrame, keys: Sequence[str], time: str, tie: Column, payload: Column
) -> DataFrame:
    timed = with_event_time(rows, time).withColumn("day_end_ms", _day_end(F.col(time)))
    given = timed.select(
        _key(*keys, "day_end_ms"), "day_end_ms", F.unix_millis(time).alias("ms"), tie, payload, time
    )
    return _bucketed(given).groupBy("bucket").transformWithStateInPandas(
        Buckets(FirstRow()), "event_time timestamp, payload string", "append", "eventTime",
        eventTimeColumnName="event_time",
    )


def unique_visitors(page_log: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """First page per device and day, emitted once the watermark has passed it."""
    rows = page_log.where(F.col("common.mid").isNotNull() & F.col("ts").isNotNull()).withColumns(
        {"_mid": F.col("common.mid"), "_time": millis_to_time(F.col("ts"))}
    )
    first = _first_rows(rows, ["_mid"], "_time", _tie(rows, tie_break), _payload(page_log))
    return _unpack(first, page_log)


def _slots(rows: DataFrame, keys: Sequence[str], time: str, sums: Sequence[str] = ()) -> DataFrame:
    """``<keys>, first, slot_time, <sums>``: the first time of each key in each slot of a window's size.

    A native aggregate, combined before its shuffle: the state behind it sees a row per key
    and slot, however many rows a key has.
    """
    present = F.col(time).isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    slot = F.window(time, codes.WINDOW_SIZE).alias("_slot")
    first = rows.where(present).groupBy(slot, *keys).agg(F.min(time).alias("first"), *[F.sum(c).alias(c) for c in sums])
    return first.select(*keys, "first", F.window_time("_slot").alias("slot_time"), *sums)


def daily_visits(rows: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """``<keys>, first_time``: when each key first appeared on each day, as the last moment of
    its 10-second slot: a slot ends after the watermark may have passed its first row, and rows
    older than that may not go out.  Windows over it are multiples of a slot."""
    key_text = F.to_json(F.struct(*keys)).alias("payload")
    slots = _slots(with_event_time(rows, time), keys, time)
    ended = slots.withColumn("day_end_ms", _day_end(F.col("first")))
    given = ended.select(
        _key(*keys, "day_end_ms"), "day_end_ms", F.unix_millis("slot_time").alias("ms"), _tie(slots, ()), key_text, "slot_time"
    )
    first = _bucketed(given).groupBy("bucket").transformWithStateInPandas(
        Buckets(FirstRow()), "event_time timestamp, payload string", "append", "eventTime",
        eventTimeColumnName="event_time",
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keys).schema)
    return first.select(
        F.col("event_time").alias("first_time"), F.from_json("payload", schema).alias("_key")
    ).select("first_time", "_key.*")


def user_jumps(page_log: DataFrame, within_ms: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """Bounces per device, emitted once the watermark has passed their deadline.

    State is kept per device and time slice, as in the batch form: it stays small
    for very active devices and goes away with the slice.
    """
    slice_ms = within_ms * SLICE_FACTOR
    into_slice = F.pmod("ms", F.lit(slice_ms))
    start = F.col("ms") - into_slice
    rows = (
        page_log.where(F.col("common.mid").isNotNull() & F.col("ts").isNotNull())
        .select(
            F.col("common.mid").alias("mid"),
            F.col("ts").alias("ms"),
            _tie(page_log, tie_break),
            F.col("page.last_page_id").isNull().alias("opens"),
            _payload(page_log),
            millis_to_time(F.col("ts")).alias("event_time"),
        )
        .withColumn(
            "_slice",
            F.explode(
                F.when(into_slice < within_ms, F.array(start, start - slice_ms)).otherwise(
                    F.array(start)
                )
            ),
        )
        .withColumn("context", F.col("_slice") < start)
    )
    given = with_event_time(rows, "event_time").select(
        _key("mid", "_slice"), "ms", "tie", "opens", "context", "payload", "event_time"
    )
    jumps = _bucketed(given).groupBy("bucket").transformWithStateInPandas(
        Buckets(Bounces(within_ms)), "payload string", "append", "eventTime"
    )
    return _unpack(jumps, page_log)


def last_visits(rows: DataFrame, key: str, time: str) -> DataFrame:
    """``key, day``: the last visit day (days since 1970) of each key of a batch table.

    One aggregate, combined before its shuffle; the history with which a stream can start.
    """
    day = F.datediff(F.max(time), F.lit("1970-01-01").cast("date"))
    return rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key).agg(day.alias("day"))


def visit_flags(
    rows: DataFrame, key: str, time: str, visit: Column | None = None, history: DataFrame | None = None,
    sums: Sequence[str] = (),
) -> DataFrame:
    """``event_time, unique, new, gap_days`` for the first row of each key and day.

    ``event_time`` is the last moment of the row's 10-second slot, as in :func:`daily_visits`.
    ``visit`` restricts which rows count as visits.  The caller sets the watermark on
    ``time`` and unions other measures of its rows by itself.  ``history`` (from
    :func:`last_visits`) is the state of the first start: its keys are not new, and a day up
    to their last one is not a new day.  With ``sums`` each key and slot gives a further row with
    the totals of these columns and no visit, so that totals need no second copy of ``rows``.
    """
    known = None
    if history is not None:
        known = _bucketed(history.select(_key(key), "day")).groupBy("bucket")
    counted = rows if visit is None else rows.where(visit)
    slots = _slots(counted, [key], time, sums)
    given = slots.select(
        _key(key), F.unix_millis("slot_time").alias("ms"),
        F.datediff("first", F.lit("1970-01-01").cast("date")).alias("day"), *sums, "slot_time",
    )
    totals = [f", `{c}` {slots.select(c).schema[0].dataType.simpleString()}" for c in sums]
    return _bucketed(given).groupBy("bucket").transformWithStateInPandas(
        Buckets(VisitFlags(sums)), "event_time timestamp, unique int, new int, gap_days int" + "".join(totals),
        "append", "eventTime", initialState=known, eventTimeColumnName="event_time",
    )


def keep_latest(
    rows: DataFrame, key: str, version: str, tie_break: Sequence[str] = (), delay_ms: int = codes.DEDUP_DELAY_MS
) -> DataFrame:
    """Newest version per key among rows arriving within ``delay_ms`` of the first one.

    Equal versions go to the greatest tie-break values, as in batch.
    """
    packed = rows.select(
        F.col(key).alias("_key"), F.unix_micros(F.col(version)).alias("version"), _tie(rows, tie_break), _payload(rows)
    )
    latest = packed.groupBy("_key").transformWithState(
        KeepLatest(delay_ms), "payload string", "append", "processingTime"
    )
    return _unpack(latest, rows)


def _settled(
    rows: DataFrame, rule: processors.Rule, keys: Sequence[str], time: str, version: str, tie_break: Sequence[str],
    state: str | None = None,
) -> DataFrame:
    """Run a rule on versions of keys; ``time`` of its rows carries the watermark on.

    Each column travels once: as a key, as what versions are told apart by, or in the payload.
    With a name of ``state`` it is kept by key, else by bucket.
    """
    none = F.lit(processors.NO_VERSION)
    told = {*keys, *tie_break, time}
    if isinstance(rows.select(version).schema[0].dataType, T.TimestampType):
        told.add(version)
    rest = [c for c in rows.columns if c not in told]
    names = [f"_key{i}" for i in range(len(keys))] if state else []
    given = rows.where(F.col(time).isNotNull()).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], _key(*keys), F.unix_millis(time).alias("ms"),
        F.coalesce(F.unix_micros(F.col(version).cast("timestamp")), none).alias("version"),
        _tie(rows, tie_break), _payload(rows, rest), F.col(time).alias("_event_time"),
    )
    grouped = given.groupBy(*names) if state else _bucketed(given).groupBy("bucket")
    out = grouped.transformWithStateInPandas(
        ByKey(rule, state, len(keys)) if state else Buckets(rule),
        "key string, event_time timestamp, version long, tie string, payload string",
        "append", "eventTime", eventTimeColumnName="event_time",
    )
    found = {
        version: F.timestamp_micros(F.when(F.col("version") != none, F.col("version"))),
        **_parsed("payload", rows, rest), **_parsed("tie", rows, tie_break, _tie_names(rows, tie_break)),
        **_parsed("key", rows, keys), time: F.col("event_time"),
    }
    return out.select(*[found[c].alias(c) for c in rows.columns])


def keep_first(
    rows: DataFrame, keys: Sequence[str], time: str, version: str, idle_ms: int, tie_break: Sequence[str] = (),
    disorder: str = codes.WATERMARK,
) -> DataFrame:
    """The first row of each key by event time, and again after ``idle_ms`` without a row of the key.

    Equal times go to the smallest version, then the smallest tie-break values, as in
    ``dedup_first`` with ``idle``; the result does not depend on how rows arrive.  Rows may be
    late by ``disorder``.  State of a key goes once the watermark has passed its last row by
    ``idle_ms``; with an idle time of less than a minute few keys are held at once, and each has a
    state of its own.  Rows without a time are left out; ``time`` keeps milliseconds.
    """
    given = with_event_time(rows, time, disorder)
    state = "stretches" if idle_ms < codes.BUCKET_IDLE_MS else None
    return _settled(given, KeepFirst(idle_ms), keys, time, version, tie_break, state)


def keep_first_arrival(
    rows: DataFrame, keys: Sequence[str], version: str, idle_ms: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The first arriving row of each key, passed on at once; state has a time to live of ``idle_ms``."""
    packed = rows.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        F.unix_micros(F.col(version).cast("timestamp")).alias("version"), _tie(rows, tie_break), _payload(rows),
    )
    first = packed.groupBy(*[f"_key{i}" for i in range(len(keys))]).transformWithState(
        KeepFirstArrival(idle_ms), "payload string", "append", "processingTime"
    )
    return _unpack(first, rows)


def settle_latest(
    rows: DataFrame, keys: Sequence[str], time: str, version: str, delay_ms: int, tie_break: Sequence[str] = (),
    disorder_ms: int = codes.DISORDER_MS,
) -> DataFrame:
    """Newest version of each key among its rows within ``delay_ms`` of the first one, by event time.

    The repeatable form of :func:`keep_latest`, which waits by the clock.  Rows that come later
    start anew.  Rows without a time are left out; ``time`` keeps milliseconds.
    """
    given = with_event_time(rows, time, f"{delay_ms + disorder_ms} milliseconds")
    return _settled(given, SettleLatest(delay_ms), keys, time, version, tie_break)


def left_join_changes(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_time: str, right_time: str,
    keep_ms: int = codes.JOIN_KEEP_MS, disorder: str = codes.WATERMARK,
) -> DataFrame:
    """A left join as a log of changes: ``op`` (``+`` or ``-``), then the columns of both sides.

    A left row goes out at once, padded with nulls if it has no match yet; when its first match
    comes, the padded row is taken back.  Rows match if their times lie within ``keep_ms``; state
    goes when the watermark has passed that.  Left rows without a key stay padded; right rows without one are left out, and
    so are rows without a time.  Column names of the sides are distinct.
    """
    def side(rows: DataFrame, key: str, time: str, is_left: bool) -> DataFrame:
        # a left row without a key has a key of its own that no right row can have
        name = F.concat(F.lit("k"), F.col(key).cast("string"))
        name = F.coalesce(name, F.concat(F.lit("n"), F.xxhash64(*rows.columns).cast("string"))) if is_left else name
        return with_event_time(rows.where(F.col(time).isNotNull()), time, disorder).select(
            name.alias("key"), F.lit(is_left).alias("left"), F.unix_millis(time).alias("ms"),
            _payload(rows), F.col(time).alias("_time"),
        ).where("key IS NOT NULL")

    both = side(left, left_key, left_time, True).unionByName(side(right, right_key, right_time, False))
    log = _bucketed(both).groupBy("bucket").transformWithStateInPandas(
        Buckets(RetractingLeftJoin(keep_ms)), "op string, left string, right string", "update", "eventTime"
    )
    sides = [_parsed("left", left, left.columns), _parsed("right", right, right.columns)]
    return log.select("op", *[value.alias(c) for side in sides for c, value in side.items()])


def fold_changes(log: DataFrame) -> DataFrame:
    """The rows that stay of a written log of changes: each as often as it was added and not taken back."""
    columns = [c for c in log.columns if c != "op"]
    n = F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("_n")
    kept = log.groupBy(*columns).agg(n).where("_n > 0")
    return kept.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i")).drop("_i")
