"""Stateful stream operators with timers (transformWithState, row form).

Each processor keeps a constant amount of state per key (one entry per inner key for the map). Timers are event-time timers: they fire once the watermark has passed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def with_state(df: DataFrame, key: str, processor: StatefulProcessor, schema: str, mode: str = "append", time_mode: str = "EventTime") -> DataFrame:
    return df.groupBy(key).transformWithState(processor, schema, mode, time_mode)


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """The rows of one key in one micro-batch, by event time."""
    return sorted(rows, key=lambda r: (r["t"], r["seq"]))


class PreviousGap(StatefulProcessor):
    """Time since the key's previous row: (sid, seq, gap)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "t LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for r in _in_order(rows):
            if last is not None:
                yield Row(sid=key[0], seq=r["seq"], gap=r["t"] - last)
            last = r["t"]
        self.last.update((last,))

    def close(self) -> None:
        pass


class RunningMap(StatefulProcessor):
    """Inner key -> total, reported for the entry each row changes: (sid, seq, call_in, total)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getMapState("totals", "call_in INT", "total LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for r in _in_order(rows):
            inner = (r["call_in"],)
            total = r["duration"] + (self.totals.getValue(inner)[0] if self.totals.containsKey(inner) else 0)
            self.totals.updateValue(inner, (total,))
            yield Row(sid=key[0], seq=r["seq"], call_in=r["call_in"], total=total)

    def close(self) -> None:
        pass


class RunningAverage(StatefulProcessor):
    """(sid, seq, average) after each row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n LONG, total LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        n, total = self.sums.get() if self.sums.exists() else (0, 0)
        for r in _in_order(rows):
            n, total = n + 1, total + r["duration"]
            yield Row(sid=key[0], seq=r["seq"], average=total / n)
        self.sums.update((n, total))

    def close(self) -> None:
        pass


class CountTrigger(StatefulProcessor):
    """Fire and purge after every `size` rows: (sid, last_seq, total)."""

    def __init__(self, size: int) -> None:
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n LONG, total LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        n, total = self.sums.get() if self.sums.exists() else (0, 0)
        for r in _in_order(rows):
            n, total = n + 1, total + r["duration"]
            if n == self.size:
                yield Row(sid=key[0], last_seq=r["seq"], total=total)
                n, total = 0, 0
        self.sums.update((n, total))

    def close(self) -> None:
        pass


class AnchoredTotal(StatefulProcessor):
    """The first row opens a window of `length` microseconds, its end reports and clears it: (sid, anchor, total, n)."""

    def __init__(self, length: int) -> None:
        self.length = length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "anchor LONG, total LONG, n LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        anchor, total, n = self.window.get() if self.window.exists() else (None, 0, 0)
        for r in _in_order(rows):
            if anchor is not None and r["t"] >= anchor + self.length:
                self.handle.deleteTimer(self._due(anchor))
                yield Row(sid=key[0], anchor=anchor, total=total, n=n)
                anchor = None
            if anchor is None:
                anchor, total, n = r["t"], 0, 0
                self.handle.registerTimer(self._due(anchor))
            total, n = total + r["duration"], n + 1
        self.window.update((anchor, total, n))

    def _due(self, anchor: int) -> int:
        return (anchor + self.length + 999) // 1000

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.window.exists():
            anchor, total, n = self.window.get()
            if expiredTimerInfo.getExpiryTimeInMs() == self._due(anchor):
                self.window.clear()
                yield Row(sid=key[0], anchor=anchor, total=total, n=n)

    def close(self) -> None:
        pass


class SilentFailure(StatefulProcessor):
    """First `fail` arms a timer, any other row disarms it, firing alerts: (sid, fail_t, alert_t)."""

    def __init__(self, timeout: int) -> None:
        self.timeout = timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.armed = handle.getValueState("armed", "t LONG")

    def _due(self, t: int) -> int:
        return (t + self.timeout + 999) // 1000

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        armed = self.armed.get()[0] if self.armed.exists() else None
        for r in _in_order(rows):
            failed = r["call_type"] == "fail"
            due = armed is not None and (r["t"] >= armed + self.timeout if failed else r["t"] > armed + self.timeout)
            if due:
                self.handle.deleteTimer(self._due(armed))
                yield Row(sid=key[0], fail_t=armed, alert_t=armed + self.timeout)
                armed = None
            if failed and armed is None:
                armed = r["t"]
                self.handle.registerTimer(self._due(armed))
            elif not failed and armed is not None:
                self.handle.deleteTimer(self._due(armed))
                armed = None
        if armed is None:
            self.armed.clear()
        else:
            self.armed.update((armed,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.armed.exists():
            armed = self.armed.get()[0]
            if expiredTimerInfo.getExpiryTimeInMs() == self._due(armed):
                self.armed.clear()
                yield Row(sid=key[0], fail_t=armed, alert_t=armed + self.timeout)

    def close(self) -> None:
        pass


class Timeouts(StatefulProcessor):
    """A `first` row waits for a `then` row less than `within` later: (sid, start_seq, end_seq), null end on timeout.

    Open rows wait in one list per key; each leaves it with its partner or its timer.
    """

    def __init__(self, first: str, then: str, within: int) -> None:
        self.first, self.then, self.within = first, then, within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "seq LONG", "t LONG")

    def _due(self, t: int) -> int:
        return (t + self.within + 999) // 1000

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for r in _in_order(rows):
            if r["call_type"] == self.first:
                self.open.updateValue((r["seq"],), (r["t"],))
                self.handle.registerTimer(self._due(r["t"]))
            elif r["call_type"] == self.then:
                for (seq,), (t,) in list(self.open.iterator()):
                    end = r["seq"] if r["t"] - t < self.within else None
                    yield Row(sid=key[0], start_seq=seq, end_seq=end)
                    self.open.removeKey((seq,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        for (seq,), (t,) in list(self.open.iterator()):
            if self._due(t) <= expiredTimerInfo.getExpiryTimeInMs():
                yield Row(sid=key[0], start_seq=seq, end_seq=None)
                self.open.removeKey((seq,))

    def close(self) -> None:
        pass


class SlotAlert(StatefulProcessor):
    """Rows of two kinds paired one to one: (sid, seq, alert_t) for those that waited `within` in vain; see `operators.pairing`.

    The state is the one row that waits. Its timer is deleted when it is met or replaced, so only what is still there gives an alert.
    """

    def __init__(self, left: str, right: str, within: int) -> None:
        self.kinds, self.within = (left, right), within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slot = handle.getValueState("slot", "seq LONG, t LONG, kind STRING")

    def _due(self, t: int) -> int:
        return (t + self.within) // 1000 + 1

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = waiting = self.slot.get() if self.slot.exists() else None
        for r in _in_order(rows):
            if r["call_type"] not in self.kinds:
                continue
            if waiting is not None and r["t"] - waiting[1] > self.within:
                yield Row(sid=key[0], seq=waiting[0], alert_t=waiting[1] + self.within)
                waiting = None
            waiting = None if waiting is not None and waiting[2] != r["call_type"] else (r["seq"], r["t"], r["call_type"])
        if before is not None and (waiting is None or waiting[0] != before[0]):
            self.handle.deleteTimer(self._due(before[1]))
        if waiting is None:
            self.slot.clear()
        elif before is None or waiting[0] != before[0]:
            self.slot.update(tuple(waiting))
            self.handle.registerTimer(self._due(waiting[1]))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self.slot.exists():
            seq, t, _ = self.slot.get()
            if self._due(t) <= expiredTimerInfo.getExpiryTimeInMs():
                self.slot.clear()
                yield Row(sid=key[0], seq=seq, alert_t=t + self.within)

    def close(self) -> None:
        pass


class PersonAsKnown(StatefulProcessor):
    """Versions of a person and calls that name them, in one stream: (seq, role, name) with the person's name when the call arrives.

    Rows are (person, seq, role, name); a row without a role is a version. The state is the last name; at the same place a version comes first.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.name = handle.getValueState("name", "name STRING")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = name = self.name.get()[0] if self.name.exists() else None
        for r in sorted(rows, key=lambda r: (r["seq"], r["role"] is not None)):
            if r["role"] is None:
                name = r["name"]
            else:
                yield Row(seq=r["seq"], role=r["role"], name=name)
        if name != before:
            self.name.update((name,))

    def close(self) -> None:
        pass


class RankChanges(StatefulProcessor):
    """The `n` largest values per key as a change log: (sid, kind, rank, duration), kind "-" for what a rank loses and "+" for what it gets.

    Whoever applies the changes of a key in order holds its current ranks; ranks that stay the same give no rows.
    """

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", "duration LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = [v for (v,) in self.top.get()] if self.top.exists() else []
        now = list(before)
        for r in rows:  # never more than n values, however many rows come
            if r["duration"] is not None and (len(now) < self.n or r["duration"] > now[-1]):
                now = sorted([*now, r["duration"]], reverse=True)[: self.n]
        for rank in range(1, len(now) + 1):
            old, new = (before[rank - 1] if rank <= len(before) else None), now[rank - 1]
            if old != new:
                if old is not None:
                    yield Row(sid=key[0], kind="-", rank=rank, duration=old)
                yield Row(sid=key[0], kind="+", rank=rank, duration=new)
        if now != before:
            self.top.put([(v,) for v in now])

    def close(self) -> None:
        pass


class ExpiringTotal(StatefulProcessor):
    """Running total that starts again after `ttl` microseconds without a row: (sid, seq, total)."""

    def __init__(self, ttl: int) -> None:
        self.ttl = ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "t LONG, total LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        last, total = self.sums.get() if self.sums.exists() else (None, 0)
        for r in _in_order(rows):
            if last is not None and r["t"] - last >= self.ttl:
                total = 0
            last, total = r["t"], total + r["duration"]
            yield Row(sid=key[0], seq=r["seq"], total=total)
        self.sums.update((last, total))

    def close(self) -> None:
        pass


class StrictRun(StatefulProcessor):
    """`times` rows of one state directly after each other, overlapping: (sid, t_first, t_last).

    On a stream filtered to that state other rows may lie between; `within` then bounds the match.
    """

    def __init__(self, wanted: str, times: int, within: int | None = None) -> None:
        self.wanted, self.times, self.within = wanted, times, within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "ts ARRAY<LONG>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        recent = list(self.recent.get()[0]) if self.recent.exists() else []
        for r in _in_order(rows):
            recent = [*recent, r["t"]][-self.times :] if r["call_type"] == self.wanted else []
            if len(recent) == self.times and (self.within is None or recent[-1] - recent[0] < self.within):
                yield Row(sid=key[0], t_first=recent[0], t_last=recent[-1])
        self.recent.update((recent,))

    def close(self) -> None:
        pass


class GreedyBefore(StatefulProcessor):
    """`item`+ greedy followed by `end`: (sid, start_seq, n, end_seq) for every item when its next end row arrives."""

    def __init__(self, item: str, end: str) -> None:
        self.item, self.end = item, end

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.items = handle.getListState("items", "seq LONG")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        for r in _in_order(rows):
            if r["call_type"] == self.item:
                self.items.appendValue((r["seq"],))
            elif r["call_type"] == self.end and self.items.exists():
                waiting = [seq for (seq,) in self.items.get()]
                self.items.clear()
                for i, seq in enumerate(waiting):
                    yield Row(sid=key[0], start_seq=seq, n=len(waiting) - i, end_seq=r["seq"])

    def close(self) -> None:
        pass


def with_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark plus the integer time `t` the processors use."""
    return stream.withColumn("t", F.unix_micros(F.col(ts).cast("timestamp"))).withWatermark(ts, delay)
