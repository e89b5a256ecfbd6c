"""Failure detection and change-log audits on streams against row-by-row runs."""

import os
import random

import pytest

from pyspark.sql import Row
from pyspark.sql.types import StructType

from skytally.operators.changelog import changelog_audit, changelog_state
from skytally.sources.streams import stream_source
from skytally.streaming import live
from tests.conftest import rows

BEATS = "member STRING, heartbeat BIGINT, tick BIGINT"
LOG = "key STRING, seq BIGINT, op STRING, value DOUBLE"


def add_files(spark, path, parts, schema):
    """One file per list of rows, in the order in which the stream takes them."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        newest = max((f.path for f in os.scandir(path) if f.name.endswith(".parquet")), key=os.path.getmtime)
        count = sum(f.name.endswith(".parquet") for f in os.scandir(path))
        os.utime(newest, (1_600_000_000 + count, 1_600_000_000 + count))


def stream(spark, path, schema):
    return stream_source(spark, "parquet", path, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)


def plain_transitions(beats, end):
    """Tick by tick: heartbeats first, then the checks."""
    out, at = [], {}
    by_tick = {}
    for member, heartbeat, tick in beats:
        by_tick.setdefault(tick, []).append((member, heartbeat))
    for tick in range(end):
        for member, heartbeat in sorted(by_tick.get(tick, []), reverse=True):
            if member not in at or heartbeat > at[member][0]:
                if member not in at or at[member][2] != "alive":
                    out.append((member, tick, "alive", heartbeat))
                at[member] = [heartbeat, tick, "alive"]
        for member, entry in at.items():
            gap = tick - entry[1]
            if entry[2] == "alive" and gap > 5:
                entry[2] = "suspect"
                out.append((member, tick, "suspect", entry[0]))
            elif entry[2] == "suspect" and gap > 25:
                entry[2] = "removed"
                out.append((member, tick, "removed", entry[0]))
    return out


@pytest.fixture(scope="module")
def beats():
    r = random.Random(3)
    found = []
    for m in range(8):
        tick, beat = r.randint(0, 5), 0
        while tick < 160:
            beat += r.choice([0, 1, 1, 3, -1])
            found.append((f"m{m}", beat, tick))
            tick += r.choice([0, 1, 2, 5, 6, 7, 12, 26, 27, 40])
    return found + [("m0", 99, 180)]


def test_transitions_equal_a_row_by_row_run(spark, tmp_path, beats):
    r = random.Random(4)
    early = [b for b in beats if b[2] < 70]
    rest = [b for b in beats if b[2] >= 70]
    r.shuffle(early)
    r.shuffle(rest)
    parts = [early[::2], early[1::2], rest[::2], rest[1::2]]
    source, root = f"{tmp_path}/in", f"{tmp_path}/root"
    lag = 125  # covers how far the files are out of order
    run = lambda: rows(live.stream_failure_transitions(stream(spark, source, BEATS), lag, root))
    add_files(spark, source, parts[:2], BEATS)
    first = run()
    assert first == sorted(plain_transitions(beats, max(b[2] for b in early) - lag + 1), key=repr)
    add_files(spark, source, parts[2:], BEATS)
    second = run()  # a restart on the same folder
    assert second == sorted(plain_transitions(beats, 181 - lag), key=repr) and len(second) > len(first)
    add_files(spark, source, [[("m0", 100, 400), (None, 1, 3), ("m1", None, 3), ("m1", 5, None)]], BEATS)
    third = run()
    assert third == sorted(plain_transitions([*beats, ("m0", 100, 400)], 401 - lag), key=repr)
    assert {x[2] for x in third} == {"alive", "suspect", "removed"}


def test_late_heartbeats_are_dropped(spark, tmp_path):
    add_files(spark, f"{tmp_path}/in", [[("a", 1, 10), ("b", 1, 100)], [("a", 2, 12), ("b", 2, 101)], [("b", 3, 130)]], BEATS)
    found = rows(live.stream_failure_transitions(stream(spark, f"{tmp_path}/in", BEATS), 10))
    assert [x for x in found if x[0] == "a"] == [("a", 10, "alive", 1), ("a", 16, "suspect", 1), ("a", 36, "removed", 1)]


@pytest.fixture(scope="module")
def log():
    r = random.Random(6)
    seqs = list(range(400))
    ops = [(f"k{r.randrange(9)}", s, r.choice(["CREATE", "READ", "UPDATE", "UPDATE", "DELETE"]), r.choice([None, float(s)]))
           for s in seqs]
    return ops


def test_audit_and_state_equal_the_batch_over_shuffled_files(spark, tmp_path, log):
    lag = 60
    # Every row is at most 60 numbers behind those before it.
    moved = sorted(log, key=lambda row: row[1] + random.Random(row[1]).randint(0, 50))
    parts = [moved[i : i + 90] for i in range(0, 400, 90)]
    source, root = f"{tmp_path}/in", f"{tmp_path}/root"
    final = lambda top: spark.createDataFrame([x for x in log if x[1] <= top - lag], LOG)
    add_files(spark, source, parts[:2], LOG)
    top = max(x[1] for part in parts[:2] for x in part)
    run = lambda: rows(live.stream_changelog_audit(stream(spark, source, LOG), lag, root))
    assert run() == rows(changelog_audit(final(top)))  # said while the log runs
    add_files(spark, source, [*parts[2:], [(None, 1, "READ", None), ("k1", None, "READ", None)]], LOG)
    expected = rows(changelog_audit(final(399)))
    assert run() == expected and len(expected) == 400 - lag
    state = live.stream_changelog_state(stream(spark, source, LOG), lag)
    assert rows(state) == rows(changelog_state(final(399)))


def test_rows_that_come_too_late_are_dropped(spark, tmp_path):
    parts = [[("a", 1, "CREATE", 1.0), ("a", 200, "READ", None)], [("a", 50, "DELETE", None), ("a", 201, "READ", None)],
             [("a", 300, "READ", None)]]
    add_files(spark, f"{tmp_path}/in", parts, LOG)
    found = rows(live.stream_changelog_audit(stream(spark, f"{tmp_path}/in", LOG), 20))
    assert found == [("a", 1, "CREATE", True), ("a", 200, "READ", True), ("a", 201, "READ", True)]


class _Store:
    """States in memory; counts the calls, each of which is a message to the state store."""

    def __init__(self):
        self.calls, self.timers = 0, []

    def _state(self, *_):
        return _Held(self)

    getValueState = getListState = getMapState = _state

    def registerTimer(self, expiry):
        self.timers.append(expiry)

    def deleteTimer(self, expiry):
        self.timers.remove(expiry)


class _Held:
    def __init__(self, store):
        self.store, self.value = store, None

    def __getattr__(self, name):
        def call(*args):
            self.store.calls += 1
            if name == "exists":
                return self.value is not None
            if name in ("get", "iterator"):
                return self.value if self.value is None or isinstance(self.value, tuple) else iter(self.value)
            if name == "appendList":
                self.value = [*(self.value or []), *args[0]]
            elif name in ("update", "put"):
                self.value = args[0]
            elif name == "clear":
                self.value = None
        return call


def test_calls_on_the_state_do_not_grow_with_the_rows(spark):
    class Times:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = lambda: at

    store = _Store()
    auditor = live.ChangeAuditor(StructType().add("value", "double")["value"])
    auditor.init(store)
    log = [Row(key="k", seq=s, op="CREATE" if s == 7 else "UPDATE", value=float(s)) for s in range(5000)]
    random.Random(1).shuffle(log)
    for part in (log[:3000], log[3000:]):
        assert not list(auditor.handleInputRows(("k",), iter(part), Times(0)))
    assert store.timers == [999]
    store.timers.clear()
    said = list(auditor.handleExpiredTimer(("k",), Times(4_000_000), None))
    assert [(r.seq, r.success, r.live_value) for r in said] == [(s, s >= 7, float(s) if s >= 7 else None) for s in range(4000)]
    assert store.timers == [4_000_999] and store.calls < 30
    store.timers.clear()
    said += list(auditor.handleExpiredTimer(("k",), Times(9_000_000), None))
    assert [r.seq for r in said] == list(range(5000)) and not store.timers and store.calls < 40
