"""Answers while a log is still running: failure detection and change-log audits with state and timers.

Rows may arrive in any order within a lag of logical time (ticks or sequence numbers). Each key keeps its rows until the
watermark has passed their time, and is then continued in order; a timer wakes it when its next row or deadline is due.
What has been said is final. A row whose time the watermark has passed when it arrives comes too late and is dropped.

Times are whole numbers from 0. The watermark counts them as seconds (one up, as it begins at 0). When the available
input is used up, everything up to ``lag`` below the largest time seen has been answered.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from skytally.operators.membership import FAIL_TICKS, REMOVE_TICKS
from skytally.streaming.runner import RunningTable, run_append, use_rocksdb_state

_TIME = StructType([StructField("time", LongType())])
_CHUNK = 1000  # rows that wait in one element of the state


class _InOrder(StatefulProcessor):
    """One key's rows in order of time, behind the watermark."""

    waiting_schema: StructType  # what is kept of a row until it is due
    state_schema: StructType

    def row(self, row: Row) -> tuple[int, tuple]:
        """Time and what is kept."""
        raise NotImplementedError

    def merged(self, first: tuple, second: tuple) -> tuple:
        """What stays of two rows of one key and time."""
        return first

    def step(self, key: Any, state: tuple | None, time: int, kept: tuple) -> tuple[tuple, Row | None]:
        """The state after a row, and what is said of it."""
        raise NotImplementedError

    def deadline(self, state: tuple | None) -> int | None:
        """When something happens without a row."""
        return None

    def missed(self, key: Any, state: tuple) -> tuple[tuple, Row]:
        """The state after the deadline, and what is said of it."""
        raise NotImplementedError

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        arrays = [StructField(f.name, ArrayType(f.dataType)) for f in (*_TIME, *self.waiting_schema)]
        self.waiting = handle.getListState("waiting", StructType(arrays))
        self.state = handle.getValueState("state", self.state_schema)
        self.timer = handle.getValueState("timer", _TIME)

    @staticmethod
    def _chunks(rows: dict[int, tuple]) -> list[tuple]:
        """Elements of the state: many rows by column, since every call on the state is a message to the store."""
        listed = [(time, *kept) for time, kept in rows.items()]
        return [tuple(map(list, zip(*listed[i : i + _CHUNK]))) for i in range(0, len(listed), _CHUNK)]

    def _waiting(self) -> dict[int, tuple]:
        """Rows that wait, by time, those of one time merged in the order in which they came."""
        waiting: dict[int, tuple] = {}
        for chunk in self.waiting.get():
            for time, *kept in zip(*chunk):
                waiting[time] = self.merged(waiting[time], tuple(kept)) if time in waiting else tuple(kept)
        return waiting

    def _wake_at(self, time: int | None) -> None:
        """Let the key be woken when the watermark has passed ``time``, and at no other time."""
        expiry = None if time is None else (time + 1) * 1000 - 1
        last = self.timer.get()
        if last is not None and last[0] == expiry:
            return
        if last is not None:
            self.handle.deleteTimer(last[0])
        if expiry is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(expiry)
            self.timer.update((expiry,))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        found: dict[int, tuple] = {}
        for row in rows:
            time, kept = self.row(row)
            if (time + 1) * 1000 > passed:
                found[time] = self.merged(found[time], kept) if time in found else kept
        if found:
            self.waiting.appendList(self._chunks(found))
            last = self.timer.get()
            woken = None if last is None else last[0] // 1000
            first = min(found)
            if woken is None or first < woken:
                self._wake_at(first)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = timerValues.getCurrentWatermarkInMs() // 1000  # times below are due
        held = self.state.get()
        state = None if held is None else tuple(held)
        waiting = self._waiting()
        self.timer.clear()  # it has fired
        said: list[Row] = []

        def until(limit: int) -> None:
            nonlocal state
            while (at := self.deadline(state)) is not None and at < limit:
                state, row = self.missed(key, state)
                said.append(row)

        due = sorted(t for t in waiting if t < end)
        for time in due:
            until(time)
            state, row = self.step(key, state, time, waiting.pop(time))
            if row is not None:
                said.append(row)
        if waiting and due:
            self.waiting.put(self._chunks(waiting))
        elif due:
            self.waiting.clear()
        until(end)
        if state is not None:
            self.state.update(state)
        at = self.deadline(state)
        self._wake_at(min([*waiting, *([] if at is None else [at])], default=None))
        return iter(said)

    def close(self) -> None:
        pass


class FailureDetector(_InOrder):
    """Rows (member, heartbeat, tick). Says when a member is alive, suspect, removed or back.

    Only a larger heartbeat is a sign of life. A member is suspect after ``FAIL_TICKS`` ticks without one and removed
    after ``REMOVE_TICKS`` more; a heartbeat at the very tick still counts. A larger heartbeat clears both.
    """

    waiting_schema = StructType().add("heartbeat", "long")
    state_schema = StructType().add("heartbeat", "long").add("tick", "long").add("status", "string")

    def row(self, row: Row) -> tuple[int, tuple]:
        return row["tick"], (row["heartbeat"],)

    def merged(self, first: tuple, second: tuple) -> tuple:
        return max(first, second)

    def deadline(self, state: tuple | None) -> int | None:
        if state is None or state[2] == "removed":
            return None
        return state[1] + FAIL_TICKS + 1 + (REMOVE_TICKS if state[2] == "suspect" else 0)

    def missed(self, key: Any, state: tuple) -> tuple[tuple, Row]:
        status = "suspect" if state[2] == "alive" else "removed"
        return (state[0], state[1], status), self._said(key, self.deadline(state), status, state[0])

    def step(self, key: Any, state: tuple | None, time: int, kept: tuple) -> tuple[tuple | None, Row | None]:
        heartbeat = kept[0]
        if state is not None and heartbeat <= state[0]:
            return state, None
        row = None if state is not None and state[2] == "alive" else self._said(key, time, "alive", heartbeat)
        return (heartbeat, time, "alive"), row

    @staticmethod
    def _said(key: Any, tick: int, status: str, heartbeat: int) -> Row:
        return Row(member=key[0], tick=tick, status=status, heartbeat=heartbeat)


class ChangeAuditor(_InOrder):
    """Rows (key, seq, op, value), one for each key and seq. Says whether each succeeds, and what the key holds then.

    A create always succeeds and keeps the first value while the key exists; the others need an existing key.
    """

    def __init__(self, value: StructField):
        self.waiting_schema = StructType().add("op", "string").add(value)
        self.state_schema = StructType().add("live", "boolean").add("live_seq", "long").add(value)

    def row(self, row: Row) -> tuple[int, tuple]:
        return row["seq"], (row["op"], row["value"])

    def step(self, key: Any, state: tuple | None, time: int, kept: tuple) -> tuple[tuple, Row]:
        op, value = kept
        live, at, held = state or (False, None, None)
        success = live or op == "CREATE"
        if (op == "CREATE" and not live) or (op == "UPDATE" and live):
            live, at, held = True, time, value
        elif op == "DELETE":
            live, at, held = False, None, None
        said = Row(key=key[0], seq=time, op=op, success=success, live=live, live_seq=at, live_value=held)
        return (live, at, held), said


def _run(
    rows: DataFrame, key: str, time: str, lag: int, processor: _InOrder, output: StructType, root: str | None
) -> RunningTable:
    use_rocksdb_state(rows.sparkSession)
    timed = rows.withColumn("_time", F.timestamp_seconds(F.col(time) + 1)).withWatermark("_time", f"{lag} seconds")
    # The watermark is kept on the way to this point; a processor takes its time from the row.
    said = timed.drop("_time").groupBy(key).transformWithState(processor, output, "append", "EventTime")
    return run_append(said, root)


def stream_failure_transitions(heartbeats: DataFrame, lag: int = 12, root: str | None = None) -> DataFrame:
    """``(member, tick, status, heartbeat)`` of every change of a member's status, final ``lag`` ticks behind.

    Rows without member, heartbeat or tick do not count, nor do those that come more than ``lag`` ticks late.
    """
    known = heartbeats.dropna(subset=["member", "heartbeat", "tick"])
    output = StructType([known.schema["member"]]).add("tick", "long").add("status", "string").add("heartbeat", "long")
    table = _run(known, "member", "tick", lag, FailureDetector(), output, root)
    return table.changes(heartbeats.sparkSession).select(*output.names)


def run_changelog_audit(log: DataFrame, lag: int = 100, root: str | None = None) -> RunningTable:
    """Audit a running change log (key, seq, op, value): one row for each operation, ``lag`` sequence numbers behind.

    Rows without key or seq do not count, nor do those that come more than ``lag`` numbers late.
    """
    known = log.dropna(subset=["key", "seq"]).select("key", F.col("seq").cast("long").alias("seq"), "op", "value")
    value = known.schema["value"]
    output = StructType([known.schema["key"]]).add("seq", "long").add("op", "string").add("success", "boolean")
    output = output.add("live", "boolean").add("live_seq", "long").add("live_value", value.dataType)
    return _run(known, "key", "seq", lag, ChangeAuditor(value), output, root)


def stream_changelog_audit(log: DataFrame, lag: int = 100, root: str | None = None) -> DataFrame:
    """``(key, seq, op, success)`` of the operations that are final."""
    return run_changelog_audit(log, lag, root).changes(log.sparkSession).select("key", "seq", "op", "success")


def stream_changelog_state(log: DataFrame, lag: int = 100, root: str | None = None) -> DataFrame:
    """``(key, seq, value)`` of the keys that exist after the operations that are final."""
    said = run_changelog_audit(log, lag, root).changes(log.sparkSession)
    newest = said.groupBy("key").agg(F.max_by(F.struct("live", "live_seq", "live_value"), "seq").alias("_now"))
    return newest.where("_now.live").select(
        "key", F.col("_now.live_seq").alias("seq"), F.col("_now.live_value").alias("value"))
