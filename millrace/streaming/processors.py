"""Keyed state on streams: alarms, changelogs, timers and patterns per key.

Operators that depend on the order of events hold a key's rows in state until
the watermark has passed them and fold them in event order, so rows may come in
any order that the watermark allows, within and across micro-batches. A key's
memory is bounded by what falls inside the watermark's delay. Keys are dealt by
their hash over groups, and a group's keys share one list of held rows, one
timer and one stored value: what a micro-batch costs then goes by rows, not by
calls to the state store for each key. Row times are microseconds; Spark's
timers count milliseconds, so a timer is set for the first millisecond at or
after its time.
"""

from __future__ import annotations

import math
import pickle
from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

Out = Iterator[pd.DataFrame]

# Columns that carry a row's group, its time, its null columns, and its key and values to a
# processor (pandas tuples rename those that begin with an underscore).
GROUP, MICROS, NULLS, VALUE = "row_group", "row_us", "row_nulls", "row_v"

# How many rows one stored value holds.
CHUNK = 10_000


class KeyedProcessor(StatefulProcessor):
    """Takes a key's rows as they come; ``fire`` answers a timer."""

    state: str = ""
    output: list[str] = []

    def __init__(self, key: str):
        self.key = key

    def init(self, handle) -> None:
        self.handle = handle
        if self.state:
            self.value = handle.getValueState("state", self.state)

    def _frame(self, key, out: list[tuple]) -> pd.DataFrame:
        # As objects, whole numbers beside nulls stay whole.
        return pd.DataFrame([(*key, *row) for row in out], columns=[self.key, *self.output], dtype=object)

    def close(self) -> None:
        pass


def _one(key):
    """The key as it is looked up: Spark groups all NaN together."""
    return math.nan if key != key else key


class InEventOrder(KeyedProcessor):
    """Holds rows until the watermark has passed them; subclasses fold them in event order.

    ``columns`` are handed to ``fold`` after the row's time; ``order`` names
    those that break ties of time, nulls first. A key's state is any value that
    pickles, None for none; it may have a ``deadline``, at which ``expire`` is
    called if no row came up to then. One timer per group wakes at the earliest
    of the rows held and the deadlines; ``name`` is the key at work.
    """

    def __init__(self, key: str, columns: list[str], order: list[str]):
        super().__init__(key)
        self.columns, self.order = columns, [columns.index(c) + 1 for c in order]

    def init(self, handle) -> None:
        super().init(handle)
        self.held = handle.getListState("held", "rows binary")
        self.states = handle.getValueState("states", "by_key binary")
        self.timer = handle.getValueState("timer", "at bigint")

    def due(self, time: str) -> Column:
        """When a row is folded, in microseconds."""
        return F.unix_micros(time)

    def handleInputRows(self, key, rows, timerValues) -> Out:
        soonest = None
        for frame in rows:
            if len(frame):
                self._hold(list(zip(*(frame[c].tolist() for c in self.fields))))
                first = int(frame[MICROS].min())
                soonest = first if soonest is None else min(soonest, first)
        if soonest is not None:
            self._wake(soonest, earlier_only=True)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Out:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        due, later = defaultdict(list), []
        for (rows,) in self.held.get():
            for row in pickle.loads(rows):
                if row[0] > passed:
                    later.append(row)
                    continue
                name, *values = (None if row[1] >> k & 1 else v for k, v in enumerate(row[2:])) if row[1] else row[2:]
                due[_one(name)].append((row[0], *values))
        self.held.clear()
        self._hold(later)
        states = {_one(k): v for k, v in pickle.loads(self.states.get()[0]).items()} if self.states.exists() else {}
        out, waits = [], [min(r[0] for r in later)] if later else []
        for self.name, rows in due.items():
            rows.sort(key=lambda r: (r[0], *((r[k] is not None, r[k]) for k in self.order)))
            more, states[self.name] = self.fold(states.get(self.name), rows)
            out += [(self.name, *row) for row in more]
        for self.name, state in states.items():
            while (end := self.deadline(state)) is not None and end <= passed:
                more, state = self.expire(state)
                out += [(self.name, *row) for row in more]
            states[self.name] = state
            if end is not None:
                waits.append(end)
        states = {k: v for k, v in states.items() if v is not None}
        if states:
            self.states.update((pickle.dumps(states),))
        else:
            self.states.clear()
        self.timer.clear()
        if waits:
            self._wake(min(waits))
        if out:
            yield self._frame((), out)

    def _hold(self, rows: list[tuple]) -> None:
        for k in range(0, len(rows), CHUNK):
            self.held.appendValue((pickle.dumps(rows[k:k + CHUNK]),))

    def _wake(self, micros: int, earlier_only: bool = False) -> None:
        at = -(-micros // 1000)
        old = self.timer.get()[0] if earlier_only and self.timer.exists() else None
        if old is not None and old <= at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def fold(self, state, rows: list[tuple]) -> tuple[list[tuple], object]:
        """Results of the rows (time, *columns), and the state after them."""
        raise NotImplementedError

    def deadline(self, state) -> int | None:
        return None

    def expire(self, state):
        return [], None


def _blank(kind: T.DataType):
    """A value that stands where a column is null, so that types survive pandas."""
    if isinstance(kind, T.StringType):
        return F.lit("")
    if isinstance(kind, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(kind) if isinstance(kind, T.NumericType) else F.lit(None).cast(kind)


def apply(stream: DataFrame, processor: KeyedProcessor, schema: str, time: str | None = None, groups: int = 256) -> DataFrame:
    """Run a processor over the rows of each key.

    ``time`` is the watermarked column, for processors in event order; without
    it timers go by processing time. Processors in event order take numbers,
    booleans and strings; rows without a time have no place in the order and
    are left out, as are rows behind the watermark. Their keys are dealt over
    ``groups``, fixed at the first start: some thousand keys to a group are
    well, and many more groups than state partitions.
    """
    by = processor.key
    if isinstance(processor, InEventOrder):
        columns, due = [by, *processor.columns], processor.due(time)
        nulls = sum((F.col(c).isNull().cast("int") * (1 << k) for k, c in enumerate(columns)), F.lit(0))
        values = [F.coalesce(F.col(c), _blank(stream.schema[c].dataType)).alias(f"{VALUE}{n}") for n, c in enumerate(columns)]
        processor.fields = [MICROS, NULLS, *(f"{VALUE}{n}" for n in range(len(columns)))]
        group = F.pmod(F.xxhash64(by), F.lit(groups)).cast("int")
        stream = stream.where(F.col(time).isNotNull() & due.isNotNull())
        stream, by = stream.select(group.alias(GROUP), time, due.alias(MICROS), nulls.alias(NULLS), *values), GROUP
    return stream.groupBy(by).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime" if time else "ProcessingTime"
    )


class JumpAlarm(InEventOrder):
    """Rows that differ from the key's previous row by more than ``over``."""

    output = ["event_id", "previous", "value"]

    def __init__(self, key, ident: str, value: str, over: float):
        super().__init__(key, [ident, value], [ident])
        self.over = over

    def fold(self, state, rows):
        last, out = state[0] if state else None, []
        for _, ident, value in rows:
            if last is not None and value is not None and abs(value - last) > self.over:
                out.append((ident, last, value))
            last = None if value is None else float(value)
        return out, (last,) if rows else state


class Changelog(InEventOrder):
    """Each change of the key's sum: the old total taken back, the new added."""

    output = ["event_id", "op", "total"]

    def __init__(self, key, ident: str, value: str):
        super().__init__(key, [ident, value], [ident])

    def fold(self, state, rows):
        total, fresh, out = (0, True, []) if state is None else (state[0], False, [])
        for _, ident, value in rows:
            if not fresh:
                out.append((ident, "-", total))
            total, fresh = total + int(value or 0), False
            out.append((ident, "+", total))
        return out, None if fresh else (total,)


class RunningTop3(InEventOrder):
    """The key's three largest values after each row, equal values kept."""

    output = ["event_id", "top1", "top2", "top3"]

    def __init__(self, key, ident: str, value: str):
        super().__init__(key, [ident, value], [ident])

    def fold(self, state, rows):
        best, out = list(state[0]) if state else [], []
        for _, ident, value in rows:
            if value is not None:
                best = sorted([*best, float(value)], reverse=True)[:3]
            out.append((ident, *best, *[None] * (3 - len(best))))
        return out, (best,)


class RunningAverage(InEventOrder):
    """The key's average after each row, from its sum and count; nulls do not count."""

    output = ["event_id", "average"]

    def __init__(self, key, ident: str, value: str):
        super().__init__(key, [ident, value], [ident])

    def fold(self, state, rows):
        (total, n), out = state or (0.0, 0), []
        for _, ident, value in rows:
            if value is not None:
                total, n = total + value, n + 1
            out.append((ident, total / n if n else None))
        return out, (total, n)


class EventTimers(InEventOrder):
    """A timer at each row's time plus a delay; every firing gives a row."""

    output = ["fired_ms"]

    def __init__(self, key, millis: str, delay_ms: int):
        super().__init__(key, [], [])
        self.millis, self.delay = millis, delay_ms

    def due(self, time: str) -> Column:
        return (F.col(self.millis).cast("bigint") + self.delay) * 1000

    def fold(self, state, rows):
        return [(at // 1000,) for at in sorted({at for at, in rows})], None


class ProcessingTimers(KeyedProcessor):
    """A timer ``delay_ms`` after a key's rows arrive; every firing gives a row.

    Use it without a time column and with a trigger that keeps running, since
    only a running query can fire it.
    """

    state, output = "rows bigint", ["rows"]

    def __init__(self, key, delay_ms: int):
        super().__init__(key)
        self.delay = delay_ms

    def handleInputRows(self, key, rows, timerValues) -> Out:
        seen = self.value.get()[0] if self.value.exists() else 0
        self.value.update((seen + sum(len(r) for r in rows),))
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay)
        yield self._frame(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Out:
        yield self._frame(key, [self.value.get()])


def _above(a: float, b: float) -> bool:
    """As Spark compares: NaN is the largest value and equal to itself."""
    return not math.isnan(b) if math.isnan(a) else a > b


class RisingAlarm(InEventOrder):
    """An alarm when values have kept rising for ``hold_us``.

    The first rising row starts a timer; a row that does not rise, at or before
    the deadline, cancels it; the next rising row after an alarm starts anew. A
    null neither rises nor falls, and the row after it counts as rising.
    """

    output = ["alarm_at"]

    def __init__(self, key, ident: str, value: str, hold_us: int):
        super().__init__(key, [ident, value], [ident])
        self.hold = hold_us

    def deadline(self, state):
        return state[1] if state else None

    def fold(self, state, rows):
        (last, deadline), out = state or (None, None), []
        for at, _, value in rows:
            if deadline is not None and at > deadline:
                out.append((deadline,))
                deadline = None
            if last is not None and value is not None and not _above(value, last):
                deadline = None
            elif deadline is None:
                deadline = at + self.hold
            last = None if value is None else float(value)
        return out, (last, deadline)

    def expire(self, state):
        return [(state[1],)], (state[0], None)


class NextOrTimeout(InEventOrder):
    """``first`` strictly followed by ``then`` within a bound, or timed out."""

    output = ["tag", "first_id", "last_id"]

    def __init__(self, key, ident: str, kind: str, first: str, then: str, within_us: int):
        super().__init__(key, [ident, kind], [ident])
        self.first, self.then, self.within = first, then, within_us

    def deadline(self, state):
        return state[1] + self.within if state else None

    def fold(self, state, rows):
        pending, out = state, []
        for at, ident, kind in rows:
            if pending is not None:
                if at - pending[1] >= self.within:
                    out.append(("timeout", pending[0], None))
                elif kind == self.then:
                    out.append(("match", pending[0], ident))
            pending = (ident, at) if kind == self.first else None
        return out, pending

    def expire(self, state):
        return [("timeout", state[0], None)], None


class Repeated(InEventOrder):
    """Two or more ``kind`` rows in direct succession within a bound.

    One row per closing row: the earliest row a match can start from and how
    many starts there are. The state holds the run's rows inside the bound.
    """

    output = ["first_id", "last_id", "n_matches"]

    def __init__(self, key, ident: str, column: str, kind: str, within_us: int):
        super().__init__(key, [ident, column], [ident])
        self.kind, self.within = kind, within_us

    def fold(self, state, rows):
        run, out = deque(zip(*state) if state else ()), []
        for at, ident, kind in rows:
            if kind != self.kind:
                run.clear()
                continue
            while run and at - run[0][1] >= self.within:
                run.popleft()
            if run:
                out.append((run[0][0], ident, len(run)))
            run.append((ident, at))
        return out, (tuple(list(c) for c in zip(*run)) if run else None)


class Reconcile(InEventOrder):
    """Rows of two sides matched first in, first out; each row is used once.

    A row waits for its counterpart until ``within_us`` later, then it leaves
    with the tag of its side. Only one side ever waits. The state has the side,
    the first and the last waiting rows, and which pages lie between them; the
    pages are in a map state, so taking or adding a row costs the same however
    many wait. Output: tag, the left row's id, the right row's id.
    """

    output = ["tag", "left_id", "right_id"]
    page = 256

    def __init__(self, key, ident: str, side: str, left: str, right: str, within_us: int):
        super().__init__(key, [ident, side], [side, ident])
        self.left, self.right, self.within = left, right, within_us

    def init(self, handle) -> None:
        super().init(handle)
        self.pages = handle.getMapState("pages", "name binary, place bigint", "rows binary")

    def deadline(self, state):
        return state[1][0][1] + self.within if state else None

    def _add(self, state, side, ident, at):
        """The state with one more waiting row."""
        if state is None:
            return side, [(ident, at)], 0, 0, []
        _, front, first, end, back = state
        if first == end and not back and len(front) < self.page:
            front.append((ident, at))
            return state
        back.append((ident, at))
        if len(back) < self.page:
            return state
        self.pages.updateValue((pickle.dumps(self.name), end), (pickle.dumps(back),))
        return side, front, first, end + 1, []

    def _take(self, state):
        """The first waiting row's id, and the state without it."""
        side, front, first, end, back = state
        ident, _ = front.pop(0)
        if front:
            return ident, state
        if first < end:
            place = (pickle.dumps(self.name), first)
            front, first = pickle.loads(self.pages.getValue(place)[0]), first + 1
            self.pages.removeKey(place)
        else:
            front, back = back, []
        return ident, (side, front, first, end, back) if front else None

    def expire(self, state):
        ident, after = self._take(state)
        return [(f"{state[0]}_only", ident, None) if state[0] == self.left else (f"{state[0]}_only", None, ident)], after

    def fold(self, state, rows):
        out = []
        for at, ident, side in rows:
            while state and at - state[1][0][1] >= self.within:
                more, state = self.expire(state)
                out += more
            if state and state[0] != side:
                other, state = self._take(state)
                out.append(("match", other, ident) if side == self.right else ("match", ident, other))
            else:
                state = self._add(state, side, ident, at)
        return out, state
