"""The deadline ledger as a stream: state by id with timers for what lapses, the same entries that daily batches give."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallyspark.operators.state import FORGET_DAYS

_ENTRY = "closing date, first_seen date, last_seen date, misses int"
CHANGES = f"id string, day date, {_ENTRY}, gone boolean"
#: What the stream needs to keep state with timers.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _lapse(closing: datetime.date | None, last_seen: datetime.date | None, forget: int) -> datetime.date | None:
    """The day on which a daily run takes an entry out, if nothing comes."""
    days = [closing + datetime.timedelta(1)] if closing else []
    if last_seen:
        days.append(last_seen + datetime.timedelta(forget + 1))
    return min(days, default=None)


def _at(day: datetime.date) -> int:
    return int(datetime.datetime(day.year, day.month, day.day, tzinfo=datetime.UTC).timestamp() * 1000)

_CHANGE = Row("id", "day", "closing", "first_seen", "last_seen", "misses", "gone")


class LedgerProcessor(StatefulProcessor):
    """An entry a key; readings in the order of their days, and a timer for the day on which the entry lapses."""

    def __init__(self, forget: int = FORGET_DAYS):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _ENTRY)

    def _held(self) -> tuple | None:
        return tuple(self.entry.get()) if self.entry.exists() else None

    def _wait(self, before: tuple | None, now: tuple | None) -> None:
        """One timer a key: the old one goes where the day on which the entry lapses moves."""
        old, new = (_lapse(e[0], e[2], self.forget) if e else None for e in (before, now))
        if old == new:
            return
        if old:
            self.handle.deleteTimer(_at(old))
        if new:
            self.handle.registerTimer(_at(new))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        days: dict[datetime.date, datetime.date | None] = {}
        for r in rows:  # a day's readings of a key are one: its latest closing, or a miss
            seen = days.get(r["day"])
            days[r["day"]] = max((c for c in (seen, r["closing"]) if c), default=None)
        before = entry = self._held()
        for day in sorted(days):
            lapsed = entry and _lapse(entry[0], entry[2], self.forget)
            if lapsed and lapsed < day:  # a run before this day has taken it out
                entry = None
            closing, first, last, misses = entry or (None, None, None, 0)
            hit = days[day]
            entry = (hit, first or day, day, 0) if hit else (closing, first, last, misses + 1)
            due = _lapse(entry[0], entry[2], self.forget)
            gone = due is not None and due <= day
            yield _CHANGE(key[0], day, *entry, gone)
            entry = None if gone else entry
        self._wait(before, entry)
        if entry:
            self.entry.update(entry)
        elif before:
            self.entry.clear()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entry = self._held()
        due = entry and _lapse(entry[0], entry[2], self.forget)
        if due and _at(due) <= expiredTimerInfo.getExpiryTimeInMs():
            self.entry.clear()
            yield _CHANGE(key[0], due, *entry, True)

    def close(self) -> None:
        pass


def ledger_changes(readings: DataFrame, forget: int = FORGET_DAYS, late: str = "1 day") -> DataFrame:
    """(id, day, closing, first_seen, last_seen, misses, gone): the entry after each day's readings of an id, and a last row when it goes.

    ``readings`` is a stream of (id string, day date, ts timestamp, closing date), ts being
    the event time of the day; a null closing is a miss. Entries that lapse while nothing comes go by a timer once the
    watermark passes that day; readings later than ``late`` are left out. An id's last row that isn't gone is
    the entry that ``operators.state.ledger`` holds after daily runs. Misses of an id that was
    never seen are kept, as there.
    """
    spark = readings.sparkSession
    spark.conf.set(*PROVIDER)
    timed = readings.select("id", "day", "ts", "closing").filter("id IS NOT NULL AND day IS NOT NULL").withWatermark("ts", late)
    return timed.groupBy("id").transformWithState(statefulProcessor=LedgerProcessor(forget), outputStructType=CHANGES, outputMode="Update", timeMode="EventTime")
