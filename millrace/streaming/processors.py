"""State processors.

They see rows in no particular order.  A processor therefore waits until the
watermark has passed a row before it decides on it, and then goes by event
time; that makes the result the same as in batch, however rows arrive.

What goes by event time is a ``Rule`` on the rows of one key.  Keys come in buckets by their
hash, and a ``Buckets`` processor keeps what a rule holds of all keys of a bucket as one
value with one timer: a micro-batch asks the state store a few times per bucket, not a
dozen times per key and timer.

Rows travel as text (``payload``) next to the few values the decision needs, so
one processor serves every row type.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def tie_order(tie: str, nulls_last: bool) -> tuple:
    """Sort key of tie-break values given as a JSON object, typed and null-aware.

    Names of floating-point values end in ``f``; NaN sorts after all numbers.
    """
    out = []
    for name, value in json.loads(tie, parse_float=Decimal).items():
        if value is None:
            out.append((2 if nulls_last else -1, 0))
        elif name.endswith("f") and (number := float(value)) != number:
            out.append((1, 0))
        else:
            out.append((0, number if name.endswith("f") else value))
    return tuple(out)


def _passed(timer_values, expired) -> int:
    """All rows up to here have arrived: the first timer of a batch settles all of them."""
    return max(expired.getExpiryTimeInMs(), timer_values.getCurrentWatermarkInMs())


#: Stands for a null version; no time is this far back.
NO_VERSION = -(1 << 63)


class Rule:
    """How the rows of one key are held and when they go out.

    What is held is plain values; a row that goes out is a tuple of ``columns``, with
    milliseconds as its ``event_time``.
    """

    columns: tuple[str, ...] = ("event_time", "payload")
    #: Microseconds added to the event time of a row that goes out.
    late_us = 0
    #: Whether a row that goes out begins with its key.
    with_key = False

    def add(self, held, rows: list[tuple]) -> tuple:
        """What is held after more rows, and the rows that go out at once."""
        raise NotImplementedError

    def due(self, held) -> int | None:
        """The time (milliseconds) the watermark must reach for the key to be settled next."""
        raise NotImplementedError

    def settle(self, held, passed: int) -> tuple:
        """What is held once the watermark has passed ``passed`` (None: nothing), and the rows that go out."""
        raise NotImplementedError

    def start(self, row: tuple):
        """What is held of a key at the first start."""
        raise NotImplementedError


def _packed(kept: dict) -> bytes:
    """The keys of a bucket, compressed behind their size in 8 bytes."""
    plain = pickle.dumps(kept, pickle.HIGHEST_PROTOCOL)
    return len(plain).to_bytes(8, "little") + pa.Codec("zstd", compression_level=6).compress(plain, asbytes=True)


def _unpacked(packed: bytes) -> dict:
    size = int.from_bytes(packed[:8], "little")
    return pickle.loads(pa.decompress(memoryview(packed)[8:], size, "zstd", asbytes=True))


def _out(rule: Rule, name: str, rows) -> list[tuple]:
    return [(name, *r) for r in rows] if rule.with_key else rows


def _frame(rule: Rule, rows: list[tuple]) -> Iterator[pd.DataFrame]:
    if rows:
        columns = {c: pd.Series(v, dtype=object) for c, v in zip(rule.columns, zip(*rows))}
        if "event_time" in columns:
            micros = columns["event_time"].astype("int64") * 1000 + rule.late_us
            columns["event_time"] = pd.to_datetime(micros, unit="us", utc=True)
        yield pd.DataFrame(columns)


class Buckets(StatefulProcessor):
    """Runs a rule on all keys of a bucket.

    Input (no nulls): the bucket, ``key`` (text), what the rule takes, and the event time.
    Initial state: the bucket, ``key`` and what the rule starts with.
    """

    def __init__(self, rule: Rule) -> None:
        self._rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._due = handle.getValueState("due", "ms long")
        self._kept = handle.getValueState("kept", "keys binary")

    def _load(self) -> dict:
        return _unpacked(self._kept.get()[0]) if self._kept.exists() else {}

    def _save(self, kept: dict, timer: int | None) -> None:
        """Keep the keys; ``timer`` is when the bucket's timer fires, if it has one."""
        if not kept:
            self._kept.clear()
            self._due.clear()
            return
        self._kept.update((_packed(kept),))
        due = min((t for t in map(self._rule.due, kept.values()) if t is not None), default=None)
        if due is not None and (timer is None or due < timer):
            self._due.update((due,))
            self._handle.registerTimer(due)
        elif due is None:
            self._due.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        kept = self._load()
        for _, name, *values in initialState.itertuples(index=False, name=None):
            kept[name] = self._rule.start(values)
        self._save(kept, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived: dict[str, list[tuple]] = {}
        for frame in rows:
            for _, name, *values, _ in frame.itertuples(index=False, name=None):
                arrived.setdefault(name, []).append(values)
        timer = self._due.get()[0] if self._due.exists() else None
        kept, out = self._load(), []
        for name, fresh in arrived.items():
            held, at_once = self._rule.add(kept.get(name), fresh)
            if held is not None:
                kept[name] = held
            out += _out(self._rule, name, at_once)
        self._save(kept, timer)
        yield from _frame(self._rule, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = _passed(timerValues, expiredTimerInfo)
        # one of several timers that have fired settles all of the bucket
        if not self._due.exists() or self._due.get()[0] > passed:
            return
        kept, out = {}, []
        for name, held in self._load().items():
            due = self._rule.due(held)
            if due is not None and due <= passed:
                held, settled = self._rule.settle(held, passed)
                out += _out(self._rule, name, settled)
            if held is not None:
                kept[name] = held
        self._save(kept, None)
        yield from _frame(self._rule, out)


class ByKey(StatefulProcessor):
    """Runs a rule on one key, whose state is a value named ``state`` and can be read key by key.

    For rules that keep a key for a short time only, so that few keys are held at once.
    Input: as in :class:`Buckets`, with ``width`` columns of the key instead of the bucket.
    """

    def __init__(self, rule: Rule, state: str, width: int) -> None:
        self._rule, self._state, self._width = rule, state, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._held = handle.getValueState(self._state, "name string, held binary")

    def _load(self) -> tuple:
        if not self._held.exists():
            return None, None
        name, held = self._held.get()
        return name, pickle.loads(held)

    def _save(self, name: str, held) -> None:
        if held is None:
            self._held.clear()
            return
        self._held.update((name, pickle.dumps(held, pickle.HIGHEST_PROTOCOL)))
        due = self._rule.due(held)
        if due is not None:
            self._handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        _, held = self._load()
        arrived = [row[self._width : -1] for frame in rows for row in frame.itertuples(index=False, name=None)]
        name = arrived[0][0]
        held, out = self._rule.add(held, [row[1:] for row in arrived])
        self._save(name, held)
        yield from _frame(self._rule, _out(self._rule, name, out))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = _passed(timerValues, expiredTimerInfo)
        name, held = self._load()
        # one of several timers that have fired settles the key
        due = None if held is None else self._rule.due(held)
        if due is None or due > passed:
            return
        held, out = self._rule.settle(held, passed)
        self._save(name, held)
        yield from _frame(self._rule, _out(self._rule, name, out))


class FirstRow(Rule):
    """The first row of a key, which lies within one day; the key goes at the end of the day.

    Input: ``day_end_ms`` (its last millisecond), ``ms, tie, payload``.  Output: ``event_time, payload``.
    """

    # a row may come in the millisecond that the watermark has reached, and goes out behind it
    late_us = 999

    def add(self, held, rows):
        if held is not None and held[1] is None:
            return held, ()
        best = held and held[1]
        for row in rows:
            _, ms, tie, payload = row
            if best is None or ms < best[0] or (ms == best[0] and tie_order(tie, True) < tie_order(best[1], True)):
                best = (ms, tie, payload)
        return (rows[0][0], best), ()

    def due(self, held):
        day_end, best = held  # an emitted row leaves None
        return day_end if best is None else best[0]

    def settle(self, held, passed):
        day_end, best = held
        out = () if best is None else ((best[0], best[2]),)
        return (None if passed >= day_end else (day_end, None)), out


class VisitFlags(Rule):
    """First visit of each key and day, with the days since the visit day before.

    Input: ``ms, day`` (day number), a row per key and time slot.  Output: ``event_time,
    unique, new, gap_days``.  With ``sums``, totals of the slot come after ``day`` and go out at
    once in a row without a visit.  The last visit day of a key is kept for good, since a key is
    new only once.  The initial state holds ``day``, the last visit day of a key in a history.
    """

    late_us = 999

    def __init__(self, sums: Sequence[str] = ()) -> None:
        self.columns = ("event_time", "unique", "new", "gap_days", *sums)
        self._none = (None,) * len(sums)

    def start(self, row):
        return row[0], {}

    def add(self, held, rows):
        last, open_ = held or (None, {})
        totals = [(row[0], 0, 0, None, *row[2:]) for row in rows] if self._none else ()
        for ms, day, *_ in rows:
            if (last is None or day > last) and (day not in open_ or ms < open_[day]):
                open_[day] = ms
        return (last, open_), totals

    def due(self, held):
        return min(held[1].values(), default=None)

    def settle(self, held, passed):
        last, open_ = held
        out = []
        for day, ms in sorted(open_.items()):
            if ms > passed:
                continue
            del open_[day]
            if last is None or day > last:
                out.append((ms, 1, int(last is None), None if last is None else day - last, *self._none))
                last = day
        return (last, open_), out


class Bounces(Rule):
    """Opening rows followed by another opening row, or by nothing for ``within_ms``.

    Input: ``ms, tie, opens, context, payload``; context rows are only looked at.
    """

    columns = ("payload",)

    def __init__(self, within_ms: int) -> None:
        self._within_ms = within_ms

    def add(self, held, rows):
        return [*(held or ()), *map(tuple, rows)], ()

    def due(self, held):
        # openings wait for their deadline; the last row clears up
        return min((r[0] for r in held if r[2]), default=max(r[0] for r in held)) + self._within_ms

    def settle(self, held, passed):
        rows = sorted(held, key=lambda r: (r[0], tie_order(r[1], False)))
        waiting, out = [], []
        for row, after in zip(rows, rows[1:] + [None]):
            ms, _, opens, context, payload = row
            if ms + self._within_ms > passed:
                waiting.append(row)
            elif opens and not context and (
                after is None or after[0] - ms >= self._within_ms or after[2]
            ):
                out.append((payload,))
        return waiting or None, out


class KeepLatest(StatefulProcessor):
    """The newest version of a key among those arriving within ``delay_ms`` of the first.

    Input: ``version`` (microseconds), ``tie, payload``.  Equal versions: the row with the
    greatest tie-break values wins, as in batch, in whatever order rows arrive.
    """

    def __init__(self, delay_ms: int) -> None:
        self._delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._newest = handle.getValueState("newest", "version long, tie string, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = self._newest.get() if self._newest.exists() else None
        if newest is None:
            self._handle.registerTimer(
                timerValues.getCurrentProcessingTimeInMs() + self._delay_ms
            )
        for row in rows:
            if newest is None or row.version > newest[0] or (
                row.version == newest[0] and tie_order(row.tie, False) > tie_order(newest[1], False)
            ):
                newest = (row.version, row.tie, row.payload)
        self._newest.update(newest)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._newest.exists():
            _, _, payload = self._newest.get()
            self._newest.clear()
            yield Row(payload=payload)


class KeepFirst(Rule):
    """The first row of each key, once more after the key was idle for ``idle_ms``.

    Input: ``ms`` (event time), ``version, tie, payload``.  Output: ``key, event_time, version, tie, payload``.
    A row is first if no row of its key lies less than or as long as ``idle_ms`` before it;
    equal times go by version, then by tie-break values.  Rows of a key that are close
    together are held as one stretch with its first row only, so a hot key takes no more
    state than a rare one.  A stretch is emitted when the watermark has passed its first row
    and forgotten when it has passed its last row by ``idle_ms``.
    """

    columns = ("key", "event_time", "version", "tie", "payload")
    with_key = True

    def __init__(self, idle_ms: int) -> None:
        self._idle_ms = idle_ms

    def _order(self, stretch: tuple) -> tuple:
        # an emitted stretch has no payload any more
        first, _, version, tie, payload = stretch
        if payload is None:
            return (first, -1, 0, ())
        # a null version sorts last, as in batch
        return (first, version == NO_VERSION, version, tie_order(tie, True))

    def add(self, held, rows):
        stretches = [*(held or ()), *((ms, ms, version, tie, payload) for ms, version, tie, payload in rows)]
        if len(stretches) > 1:
            stretches.sort(key=self._order)
        merged: list[tuple] = []
        for stretch in stretches:
            if merged and stretch[0] - merged[-1][1] <= self._idle_ms:
                before = merged[-1]
                merged[-1] = (before[0], max(before[1], stretch[1]), *before[2:])
            else:
                merged.append(stretch)
        return merged, ()

    def due(self, held):
        return min(first if payload is not None else last + self._idle_ms + 1 for first, last, _, _, payload in held)

    def settle(self, held, passed):
        kept, out = [], []
        for first, last, version, tie, payload in held:
            if payload is not None and first <= passed:
                out.append((first, version, tie, payload))
                payload = tie = None
            if payload is not None or last + self._idle_ms >= passed:
                kept.append((first, last, version, tie, payload))
        return kept or None, out


class KeepFirstArrival(StatefulProcessor):
    """The first arriving row of each key; the state goes when no row came for ``idle_ms`` by the clock.

    Input as in :class:`KeepFirst`; among rows that arrive together the least version counts.
    """

    def __init__(self, idle_ms: int) -> None:
        self._idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", "yes boolean", self._idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self._seen.exists()
        best = None
        for r in rows:
            order = (r.version is None, r.version or 0, tie_order(r.tie, True))
            if not known and (best is None or order < best[0]):
                best = (order, r.payload)
        self._seen.update((True,))  # the time to live starts anew
        if best is not None:
            yield Row(payload=best[1])


class SettleLatest(Rule):
    """The newest version of a key among its rows within ``delay_ms`` (event time) of the first.

    Input: ``ms, version, tie, payload``.  Output: ``key, event_time, version, tie, payload``.  The watermark must
    lag by ``delay_ms`` and the disorder, so that when it passes the first row, all rows that
    belong to it have arrived; the row goes out then and is not late for what follows.
    """

    columns = ("key", "event_time", "version", "tie", "payload")
    with_key = True

    def __init__(self, delay_ms: int) -> None:
        self._delay_ms = delay_ms

    def add(self, held, rows):
        waiting, until = held or ([], None)
        waiting = [*waiting, *(tuple(r) for r in rows if until is None or r[0] > until)]
        return ((waiting, until) if waiting or until is not None else None), ()

    def due(self, held):
        waiting, until = held
        times = [r[0] for r in waiting]
        return min(times if until is None else [*times, until + 1])

    def settle(self, held, passed):
        rows, until = held
        rows = sorted(rows, key=lambda r: r[0])
        out = []
        while rows and rows[0][0] <= passed:
            until = rows[0][0] + self._delay_ms
            group = [r for r in rows if r[0] <= until]
            # no version is the least, so that any other one is newer
            newest = group[0] if len(group) == 1 else max(
                group, key=lambda r: (r[1], tie_order(r[2], False))
            )
            out.append(newest)
            rows = rows[len(group):]
        if until is not None and until < passed:
            until = None
        return ((rows, until) if rows or until is not None else None), out


class RetractingLeftJoin(Rule):
    """A left join of two streams that answers at once and takes back what changes.

    Input: ``left`` (side), ``ms, payload``.  Output: ``op`` (``+`` or ``-``), ``left, right``
    payloads.  A left row goes out with its matches, or padded with null when there is none;
    the first match of a padded row takes the padded one back.  Rows match if their event
    times lie within ``keep_ms``; both sides are kept until the watermark has passed that.
    """

    columns = ("op", "left", "right")

    def __init__(self, keep_ms: int) -> None:
        self._keep_ms = keep_ms

    def add(self, held, rows):
        left, right = held or ([], [])
        out = []
        for is_left, row_ms, row in rows:
            if is_left:
                found = [payload for ms, payload in right if abs(ms - row_ms) <= self._keep_ms]
                out += [("+", row, payload) for payload in found or [None]]
                left.append((row_ms, row, bool(found)))
            else:
                for i, (ms, payload, matched) in enumerate(left):
                    if abs(ms - row_ms) > self._keep_ms:
                        continue
                    if not matched:
                        out.append(("-", payload, None))
                        left[i] = (ms, payload, True)
                    out.append(("+", payload, row))
                right.append((row_ms, row))
        return (left, right), out

    def due(self, held):
        return min(r[0] for side in held for r in side) + self._keep_ms + 1

    def settle(self, held, passed):
        left, right = ([r for r in side if r[0] + self._keep_ms >= passed] for side in held)
        return ((left, right) if left or right else None), ()
