"""State of one key over a stream: folds in time order, with timers, in bounded memory.

A key's rows of a micro-batch come in no order. Up to ``HELD`` of them are sorted in memory; more are kept as sorted runs in a
state map and merged from there, so the largest key needs the memory of one run. What a fold remembers from batch to
batch is in values, lists and maps of the state store, with one entry for each code. A key has one timer at a time.

Rows behind the watermark take no part; they are returned as they come, with ``late`` set.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from operator import itemgetter

import pandas as pd
from pyspark.sql.streaming.stateful_processor import MapState, StatefulProcessor, StatefulProcessorHandle

#: Rows of a key that are sorted in memory, and rows in an entry of a stored run.
HELD, PART = 50_000, 2_000
#: Rows in a returned frame, new codes that wait for the state store, and stored codes known without asking it.
FRAME, FRESH, KNOWN = 10_000, 1_000, 100_000
MICROS = 1_000_000


class InOrder:
    """Rows of a key's frames by their first two columns, through sorted runs in ``runs`` where there are many."""

    RUNS = ("run int, part int", "rows binary")

    def __init__(self, runs: MapState, held: int):
        self.runs, self.held = runs, held

    def rows(self, frames: Iterable[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
        first_two = itemgetter(0, 1)
        waiting: list[tuple] = []
        sizes: list[int] = []

        def store() -> None:
            waiting.sort(key=first_two)
            parts = range(0, len(waiting), PART)
            for part, at in enumerate(parts):
                self.runs.updateValue((len(sizes), part), (pickle.dumps(waiting[at:at + PART]),))
            sizes.append(len(parts))
            waiting.clear()

        def stored(run: int) -> Iterator[tuple]:
            for part in range(sizes[run]):
                yield from pickle.loads(self.runs.getValue((run, part))[0])

        for frame in frames:
            waiting += zip(*(frame[c].tolist() for c in columns))
            if len(waiting) >= self.held:
                store()
        if not sizes:
            waiting.sort(key=first_two)
            yield from waiting
            return
        store()
        yield from heapq.merge(*map(stored, range(len(sizes))), key=first_two)
        self.runs.clear()


class Fold(StatefulProcessor):
    """Rows of a key in time order, and its timer. ``columns``: the input's, time in microseconds first, then what breaks ties."""

    columns: list[str]
    out: dict[str, str]
    #: How much is held in memory; the result is the same for any numbers.
    held, fresh, known = HELD, FRESH, KNOWN

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.order = InOrder(handle.getMapState("runs", *InOrder.RUNS), self.held)
        self.timer = handle.getValueState("timer", "at long")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Name the state."""

    def late(self, key, row: tuple) -> tuple:
        """What is returned for a row behind the watermark."""
        raise NotImplementedError

    def fold(self, key, rows: Iterator[tuple]) -> Iterator[tuple]:
        """Rows of the batch in order, those behind the watermark left out."""
        raise NotImplementedError

    def due(self) -> int | None:
        """When, in microseconds, the key has something to do without a row."""
        raise NotImplementedError

    def wake(self, key, now: int) -> Iterator[tuple]:
        """Time has passed ``due()``."""
        raise NotImplementedError

    def _frames(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        while part := list(islice(rows, FRAME)):
            yield pd.DataFrame(part, columns=list(self.out)).astype(self.out)

    def _set_timer(self, now: int) -> None:
        """A timer that is set already stays; if it comes too early, it is set again then."""
        at = self.due()
        if at is None or self.timer.exists():
            return
        milli = max(at // 1000, now // 1000) + 1  # strictly after
        self.handle.registerTimer(milli)
        self.timer.update((milli,))

    def handleInputRows(self, key, rows, timerValues):
        floor = timerValues.getCurrentWatermarkInMs() * 1000

        def results():
            ordered = self.order.rows(rows, self.columns)
            rest: list[tuple] = []
            for row in ordered:  # late rows come first
                if row[0] >= floor:
                    rest.append(row)
                    break
                yield self.late(key, row)

            def on_time():
                yield from rest
                yield from ordered

            yield from self.fold(key, on_time())
            self._set_timer(floor)

        yield from self._frames(results())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000

        def results():
            self.timer.clear()
            if (at := self.due()) is not None and at < now:
                yield from self.wake(key, now)
            self._set_timer(now)

        yield from self._frames(results())

    def close(self) -> None:
        pass


class Accept(Fold):
    """The first row of an id, then the first at least ``keep_for`` after the last accepted one."""

    columns = ["us", "seq"]
    out = {"task_id": "object", "seq": "int64", "us": "int64", "late": "bool"}

    def __init__(self, keep_for: int):
        self.keep_for = keep_for

    def open(self, handle):
        self.last = handle.getValueState("last", "us long")

    def late(self, key, row):
        return key[0], row[1], row[0], True

    def fold(self, key, rows):
        (last,) = before = self.last.get() or (None,)
        for us, seq in rows:
            if last is None or us - last >= self.keep_for:
                last = us
                yield key[0], seq, us, False
        if (last,) != before:
            self.last.update((last,))

    def due(self):
        last = self.last.get()
        return last[0] + self.keep_for if last else None

    def wake(self, key, now):
        self.last.clear()
        return iter(())


class Retry(Fold):
    """A task's state after each attempt, and ``retry_due`` when a retry falls due unanswered."""

    columns = ["us", "attempt_no", "event", "success"]
    out = {"task_id": "object", "attempt_no": "Int64", "state": "object", "us": "int64", "retry_count": "Int64", "next_us": "Int64",
           "late": "bool"}

    def __init__(self, delay_seconds: Callable[[int], int | None]):
        self.delay_seconds = delay_seconds

    def open(self, handle):
        self.task = handle.getValueState("task", "count long, due long")

    def late(self, key, row):
        return key[0], row[1], None, row[0], None, None, True

    def fold(self, key, rows):
        count, due = before = self.task.get() or (0, None)
        for us, number, event, success in rows:
            if due is not None and due < us:
                yield key[0], None, "retry_due", due, count, None, False
            if event in ("submitted", "started"):
                due = None
                yield key[0], number, "pending" if event == "submitted" else "running", us, count, None, False
            elif success:
                count, due = 0, None
                yield key[0], number, "cleared", us, 0, None, False
            else:
                count += 1
                delay = self.delay_seconds(count)
                due = None if delay is None else us + delay * MICROS
                yield key[0], number, "paused" if delay is None else "needs_retry", us, count, due, False
        if not count:
            self.task.clear()
        elif (count, due) != before:
            self.task.update((count, due))

    def due(self):
        task = self.task.get()
        return task[1] if task else None

    def wake(self, key, now):
        count, due = self.task.get()
        self.task.update((count, None))
        yield key[0], None, "retry_due", due, count, None, False


class Codes:
    """Different codes in the order in which they came, one state entry each. Some new ones wait in memory."""

    def __init__(self, handle: StatefulProcessorHandle, most_fresh: int, most_known: int):
        self.most_fresh, self.most_known = most_fresh, most_known
        self.listed = handle.getListState("codes", "code string")
        self.stored = handle.getMapState("stored", "code string", "stored boolean")
        self.fresh: dict[str, None] = {}
        self.known: set[str] = set()
        self.any_stored = False

    def start(self) -> None:
        """Another key: nothing in memory holds."""
        self.fresh, self.known, self.any_stored = {}, set(), self.listed.exists()

    def add(self, code: str) -> bool:
        """Whether the code is new."""
        if code in self.fresh or code in self.known:
            return False
        if self.any_stored and self.stored.containsKey((code,)):
            if len(self.known) < self.most_known:
                self.known.add(code)
            return False
        self.fresh[code] = None
        if len(self.fresh) >= self.most_fresh:
            self.save()
        return True

    def save(self) -> None:
        if self.fresh:
            self.listed.appendList([(c,) for c in self.fresh])
            for code in self.fresh:
                self.stored.updateValue((code,), (True,))
            self.known.update(islice(self.fresh, max(0, self.most_known - len(self.known))))
            self.fresh, self.any_stored = {}, True

    def all(self) -> Iterator[str]:
        if self.any_stored:
            for (code,) in self.listed.get():
                yield code
        yield from self.fresh

    def clear(self) -> None:
        if self.any_stored:
            self.listed.clear()
            self.stored.clear()
        self.fresh, self.known, self.any_stored = {}, set(), False


class Debounce(Fold):
    """A row without a code opens a window unless one is open; at its end all codes so far go out, first seen first."""

    columns = ["us", "tie", "code"]
    out = {"key": "object", "us": "int64", "position": "Int64", "code": "object", "late": "bool"}

    def __init__(self, delay: int):
        self.delay = delay

    def open(self, handle):
        self.window = handle.getValueState("window", "end long")
        self.codes = Codes(handle, self.fresh, self.known)

    def late(self, key, row):
        return key[0], row[0], None, row[2], True

    def _send(self, key, end: int) -> Iterator[tuple]:
        for i, code in enumerate(self.codes.all(), 1):
            yield key[0], end, i, code, False
        self.codes.clear()

    def fold(self, key, rows):
        (end,) = before = self.window.get() or (None,)
        self.codes.start()
        for us, _, code in rows:
            if end is not None and end <= us:
                yield from self._send(key, end)
                end = None
            if code is not None:
                self.codes.add(code)
            elif end is None:
                end = us + self.delay
        self.codes.save()
        if end is None:
            self.window.clear()
        elif (end,) != before:
            self.window.update((end,))

    def due(self):
        window = self.window.get()
        return window[0] if window else None

    def wake(self, key, now):
        self.codes.start()
        yield from self._send(key, self.due())
        self.window.clear()


class Daily(Fold):
    """The first codes of a day start a timer; when it fires, all codes of the day so far go out, once a day."""

    columns = ["us", "code", "day", "n"]
    out = {"key": "object", "day": "int32", "us": "int64", "n_codes": "int64", "code": "object", "late": "bool"}

    def __init__(self, delay: int):
        self.delay = delay

    def open(self, handle):
        # at most two timers: that of a day that ended and the new day's own
        self.held = handle.getValueState("held", "day int, count long, first long, second long, scheduled boolean, sent boolean")
        self.codes = Codes(handle, self.fresh, self.known)

    def late(self, key, row):
        return key[0], row[2], row[0], row[3], row[1], True

    def _load(self) -> None:
        self.day, self.count, first, second, self.scheduled, self.sent = self.held.get() or (None, 0, None, None, False, False)
        self.timers = [t for t in (first, second) if t is not None]
        self.codes.start()

    def _save(self) -> None:
        self.codes.save()
        if self.day is not None:
            first, second = (self.timers + [None, None])[:2]
            self.held.update((self.day, self.count, first, second, self.scheduled, self.sent))

    def _fire(self, key, until: int) -> Iterator[tuple]:
        while self.timers and self.timers[0] <= until:
            at = self.timers.pop(0)
            if self.count:
                for code in self.codes.all():
                    yield key[0], self.day, at, self.count, code, False
                self.codes.clear()
                self.count, self.sent = 0, True
            self.scheduled = False

    def fold(self, key, rows):
        self._load()
        for us, code, day, _ in rows:
            yield from self._fire(key, us)
            if day != self.day:
                self.day, self.count, self.scheduled, self.sent = day, 0, False, False
                self.codes.clear()
            self.count += self.codes.add(code)
            if not self.sent and not self.scheduled:
                self.scheduled = True
                self.timers.append(us + self.delay)
        self._save()

    def due(self):
        held = self.held.get()
        return held[2] if held else None

    def wake(self, key, now):
        self._load()
        yield from self._fire(key, now - 1)  # strictly before
        self._save()


class Totals(StatefulProcessor):
    """Sums per day. Parts of a day that ended before the watermark are returned apart, with the rows that they stand for."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "completed long, failed long, last long, n long")

    def handleInputRows(self, key, rows, timerValues):
        completed = failed = n = 0
        last = end = None
        for part in rows:
            completed, failed, n = completed + int(part["completed"].sum()), failed + int(part["failed"].sum()), n + int(part["n"].sum())
            last = max(int(part["last"].max()), last or int(part["last"].max()))
            end = int(part["day_end"].iloc[0])
        late = end <= timerValues.getCurrentWatermarkInMs() * 1000
        if not late:
            before = self.sums.get()
            if before is None:
                self.handle.registerTimer(end // 1000)
                before = (0, 0, last, 0)
            completed, failed, last, n = before[0] + completed, before[1] + failed, max(before[2], last), before[3] + n
            self.sums.update((completed, failed, last, n))
        yield pd.DataFrame({"day": [key[0]], "completed": [completed], "failed": [failed], "last": [last], "n": [n], "late": [late]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.sums.clear()
        yield from ()

    def close(self) -> None:
        pass


class Expire(StatefulProcessor):
    """Lines that wait in the state store until their time to live is over; then they are returned, equal ones once.

    A key is a slot of time and a shard of its lines; ``names`` end in the line's time. A key's lines are in parts of at most ``PART``, cut in
    the order of time, and beside each part is the time of its first line. So a tick reads only parts with lines that expire, and a key has one timer.
    """

    def __init__(self, live: int, names: list[str], clock: int):
        """``clock``: the shard of the rows that only carry the time."""
        self.live, self.names, self.clock = live, names, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "part int", "rows binary")
        self.firsts = handle.getMapState("firsts", "part int", "us long")
        self.next = handle.getValueState("next", "part int, timer long")

    def _cut(self, lines: Iterable[tuple], now: int) -> tuple[list[tuple], list[tuple]]:
        """Those that are over, and those that wait."""
        over, wait = [], []
        for line in lines:
            (over if line[-1] + self.live < now else wait).append(line)
        return over, wait

    def _put(self, part: int, lines: list[tuple]) -> None:
        """Lines in the order of time."""
        self.parts.updateValue((part,), (pickle.dumps(lines),))
        self.firsts.updateValue((part,), (lines[0][-1],))

    def _timer(self, part: int, before: int | None, first: int) -> None:
        at = (first + self.live) // 1000 + 1
        if before is not None and before <= at:
            at = before
        else:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(at)
        self.next.update((part, at))

    def _frame(self, lines: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(lines, columns=self.names)

    def handleInputRows(self, key, rows, timerValues):
        if key[1] == self.clock:
            for _ in rows:
                pass
            return
        now = timerValues.getCurrentWatermarkInMs() * 1000
        part, timer = self.next.get() or (0, None)
        first, seen = None, set()
        for frame in rows:
            over, wait = self._cut(dict.fromkeys(zip(*(frame[c].tolist() for c in self.names))), now)
            new = [line for line in over if line not in seen]
            if new:
                seen.update(new)
                yield self._frame(new)
            wait.sort(key=itemgetter(-1))
            for at in range(0, len(wait), PART):
                self._put(part, wait[at:at + PART])
                part += 1
            if wait:
                first = wait[0][-1] if first is None else min(first, wait[0][-1])
        if first is not None:
            self._timer(part, timer, first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        part, _ = self.next.get()
        first, seen = None, set()
        for (at,), (earliest,) in list(self.firsts.iterator()):
            if earliest + self.live < now:
                over, wait = self._cut(pickle.loads(self.parts.getValue((at,))[0]), now)
                new = [line for line in over if line not in seen]
                if new:
                    seen.update(new)
                    yield self._frame(new)
                if not wait:
                    self.parts.removeKey((at,))
                    self.firsts.removeKey((at,))
                    continue
                self._put(at, wait)
                earliest = wait[0][-1]
            first = earliest if first is None else min(first, earliest)
        if first is None:
            self.next.clear()
        else:
            self._timer(part, None, first)

    def close(self) -> None:
        pass
