"""Sessions with their ordered values on a stream (T3, T4): state of our own per key.

``session_window`` keeps aggregates only.  Here each key's events of open sessions lie in a
list state; an event-time timer stands at the earliest end a session of the key can have.
When the watermark passes it, the sessions that are over are put in order and emitted as rows,
the others stay.  A key's state is bounded by its open sessions: what the watermark has
passed is gone.  Each key's events meet on one task, as any keyed state does.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lakekit.functions.scalar import seconds_of
from lakekit.streaming import windows as wn

US = 1_000_000
SERIES = "__series"     # stands for the key of a series without one


def in_order(event) -> tuple:
    """Order of events within a session: by time, then value (NULL first, NaN last, as Spark sorts)."""
    at, value = event
    return at, value is not None, value != value, value if value is not None else 0


def split_sessions(events: list[tuple], gap_us: int) -> list[list[tuple]]:
    """Ordered events cut where the time between neighbours is more than the gap."""
    out: list[list[tuple]] = []
    for event in events:
        if out and event[0] - out[-1][-1][0] <= gap_us:
            out[-1].append(event)
        else:
            out.append([event])
    return out


class SessionValues(StatefulProcessor):
    """Holds a key's events until the watermark has passed the end of their session."""

    def __init__(self, keys: Sequence[str], gap_us: int, value_type: str):
        self.keys, self.gap_us, self.value_type = list(keys), gap_us, value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = Row(*self.keys, "__start", "position", "value")
        self.events = handle.getListState("events", f"at bigint, value {self.value_type}")
        self.due = handle.getValueState("due", "ms bigint")

    def _wake(self, ms: int) -> None:
        """One timer a key, at the earliest time a session can be over."""
        known = self.due.get()[0] if self.due.exists() else None
        if known is None or ms < known:
            if known is not None:
                self.handle.deleteTimer(known)
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r["__at"], r["__value"]) for r in rows]
        self.events.appendList(new)
        self._wake(self._end(min(at for at, _ in new)))
        return iter([])

    def _end(self, last_us: int) -> int:
        return -(-(last_us + self.gap_us) // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.due.clear()
        passed = timerValues.getCurrentWatermarkInMs()
        left: list[tuple] = []
        ends: list[int] = []
        for session in split_sessions(sorted(map(tuple, self.events.get()), key=in_order), self.gap_us):
            end = self._end(session[-1][0])
            if end > passed:
                left += session
                ends.append(end)
                continue
            for position, (_, value) in enumerate(session, 1):
                yield self.row(*key, session[0][0], position, value)
        if left:
            self.events.put(left)
            self._wake(min(ends))
        else:
            self.events.clear()

    def close(self) -> None:
        pass


def _prepared(df: DataFrame, ts: str, value: str, keys: Sequence[str]) -> DataFrame:
    """keys, the time under its own name (it carries the watermark), __at (microseconds), __value."""
    named = [F.col(k) for k in keys] or [F.lit(0).alias(SERIES)]
    return df.filter(F.col(ts).isNotNull()).select(*named, F.col(ts), F.unix_micros(F.col(ts)).alias("__at"), F.col(value).alias("__value"))


def session_values_stream(stream: DataFrame, ts: str, value: str, gap: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, session_start, position, value) of each session that is over, as
    ``windows.session_values`` gives them for a table; append mode.

    ``stream`` has a watermark on ``ts``; rows behind it are too late for any session.  Events
    with a NULL key are one series, those without a time are in no session.  Needs the RocksDB
    state store (``run_stream(..., state_store=ROCKSDB)``).
    """
    by = list(keys) or [SERIES]
    rows = _prepared(stream, ts, value, keys)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ", ".join(f"`{k}` {kinds[k]}" for k in by) + f", __start bigint, position bigint, value {kinds['__value']}"
    held = rows.groupBy(*by).transformWithState(SessionValues(by, seconds_of(gap) * US, kinds["__value"]), out, "Append", "EventTime")
    return held.select(*keys, F.timestamp_micros("__start").alias("session_start"), "position", "value")


def open_session_values(spark: SparkSession, checkpoint: str, gap: str, keys: Sequence[str] = ()) -> DataFrame:
    """The sessions that are still open in a stopped stream's state, in the same rows: the final
    flush.  Read with the state data source, so the stream itself can go on later."""
    held = (spark.read.format("statestore").option("stateVarName", "events").load(checkpoint)
            .select(*(F.col(f"key.{k}").alias(k) for k in keys), "list_element.*"))
    held = held.withColumn("at", F.timestamp_micros("at"))
    return wn.session_values(held, "at", "value", gap, keys=keys)
