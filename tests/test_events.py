import random

import pytest

from pyspark.sql import functions as F

from skytally.operators import changelog, membership, replicas, sensors
from tests.conftest import rows

LOG = "key STRING, seq BIGINT, op STRING, value STRING"


def simulate(log):
    """Row by row: what exists, and which operations succeed."""
    state, audit = {}, []
    for key, seq, op, value in sorted(log, key=lambda entry: entry[1]):
        exists = key in state
        audit.append((key, seq, op, op == "CREATE" or exists))
        if op == "CREATE" and not exists or op == "UPDATE" and exists:
            state[key] = (seq, value)
        if op == "DELETE" and exists:
            del state[key]
    return sorted(((k, *v) for k, v in state.items()), key=repr), sorted(audit, key=repr)


def test_alarms(lines):
    found = sensors.alarms(sensors.parse_messages(lines(
        "2016-01-01T10:00 S1 100 ", "2016-01-01T10:00 S1 101 ", "t S2 -100", "t S2 -101", "t S3", "", "t S4 many")))
    assert rows(found.select("sensor", "value")) == [("S1", 101), ("S2", -101)]
    assert sensors.alarms(sensors.parse_messages(lines("t S 5", "t S 7")), 5, 6).count() == 1


def test_changelog_cases(spark):
    log = [("a", 1, "UPDATE", "early"), ("a", 2, "CREATE", "one"), ("a", 3, "CREATE", "two"),
           ("b", 4, "CREATE", "x"), ("b", 5, "DELETE", None), ("b", 6, "CREATE", "y"), ("b", 7, "UPDATE", "z"),
           ("c", 8, "DELETE", None), ("c", 9, "READ", None), ("d", 10, "CREATE", "q"), ("d", 11, "DELETE", None),
           ("d", 12, "UPDATE", "ghost")]
    df = spark.createDataFrame(log, LOG)
    assert rows(changelog.changelog_state(df)) == [("a", 2, "one"), ("b", 7, "z")]
    failed = changelog.changelog_audit(df).where("NOT success").select("seq")
    assert rows(failed) == sorted([(1,), (8,), (9,), (12,)], key=repr)
    assert ("DELETE", False, 1) in rows(changelog.audit_counts(changelog.changelog_audit(df)))


@pytest.mark.parametrize("width", [1, 7, 1_000_000])
def test_changelog_matches_a_row_by_row_run(spark, width):
    rng = random.Random(width)
    keys = ["hot"] * 5 + ["k1", "k2", "k3", "k4", "k5"]
    log = [(rng.choice(keys), i, rng.choice(["CREATE", "UPDATE", "UPDATE", "DELETE", "READ"]), f"v{i}") for i in range(300)]
    df = spark.createDataFrame(log, LOG).repartition(5)
    state, audit = simulate(log)
    assert rows(changelog.changelog_state(df, width)) == state
    assert rows(changelog.changelog_audit(df, width)) == audit


def test_quorum(spark):
    copies = [("all", "x"), ("all", "x"), ("all", "x"), ("two", "x"), ("two", "x"), ("two", "y"), ("none", "x"),
              ("none", "y"), ("none", "z"), ("gone", "x"), ("gone", None), ("empty", ""), ("empty", ""), ("empty", "x")]
    df = spark.createDataFrame(copies, "key STRING, value STRING")
    assert rows(replicas.quorum_read(df)) == [
        ("all", "x", True), ("empty", None, False), ("gone", None, False), ("none", None, False), ("two", "x", True)]
    acks = spark.createDataFrame([("a", True), ("a", True), ("a", False), ("b", True), ("b", None)], "key STRING, ok BOOLEAN")
    assert rows(replicas.quorum_write(acks)) == [("a", 2, True), ("b", 1, False)]


def test_a_replica_votes_once(spark):
    copies = [("twice", "r1", "x"), ("twice", "r1", "x"), ("two", "r1", "x"), ("two", "r2", "x"), ("unknown", None, "x"),
              ("unknown", "r1", "x")]
    df = spark.createDataFrame(copies, "key STRING, replica STRING, value STRING")
    assert rows(replicas.quorum_read(df, replica="replica")) == [
        ("twice", None, False), ("two", "x", True), ("unknown", None, False)]
    acks = df.withColumn("ok", F.col("value") == "x")
    assert rows(replicas.quorum_write(acks, replica="replica")) == [("twice", 1, False), ("two", 2, True), ("unknown", 1, False)]


def test_ring(spark):
    from skytally.functions.numeric import ring_position
    names = [f"node{i}" for i in range(7)]
    nodes = spark.createDataFrame([(n,) for n in names], "node STRING")
    placed = sorted(rows(nodes.select(ring_position(nodes.node), "node")))
    table = {}
    for position, replica, node in rows(replicas.ring_table(nodes)):
        table.setdefault(position, {})[replica] = node
    assert sorted(table) == list(range(512))
    for position, owners in table.items():
        order = [n for p, n in placed if p >= position] + [n for p, n in placed if p < position]
        assert [owners[r] for r in range(3)] == order[:3]
    keys = spark.range(100).withColumnRenamed("id", "key")
    assert replicas.ring_placement(keys, nodes).count() == 300
    assert rows(replicas.ring_balance(keys, nodes).selectExpr("sum(keys)", "sum(copies)")) == [(100, 300)]
    few = replicas.ring_balance(keys.limit(1), nodes)
    assert few.count() == nodes.distinct().count() and few.where("copies = 0").count() == few.count() - 3
    assert replicas.ring_table(nodes.limit(2)).count() == 0


def test_ring_with_more_nodes_than_positions(spark):
    nodes = spark.range(40).selectExpr("CAST(id AS STRING) AS node")
    found = replicas.ring_table(nodes, ring_size=4)
    assert found.count() == 12 and found.where("node IS NULL").count() == 0


def test_heartbeats(spark):
    beats = [("alive", 1, 90), ("alive", 2, 95), ("suspect", 3, 94), ("edge", 4, 75), ("removed", 5, 74),
             ("stale", 9, 60), ("stale", 9, 99), ("stale", 8, 100), ("back", 1, 50), ("back", 2, 100)]
    df = spark.createDataFrame(beats, "member STRING, heartbeat BIGINT, tick BIGINT")
    found = membership.heartbeat_status(membership.last_advance(df), 100)
    assert rows(found.select("member", "gap", "status")) == [
        ("alive", 5, "alive"), ("back", 0, "alive"), ("edge", 25, "suspect"), ("removed", 26, "removed"),
        ("stale", 40, "removed"), ("suspect", 6, "suspect")]


def test_membership_log(lines):
    log = membership.parse_membership_log(lines(
        " 1.0.0.0:0 [0] APP", " 3.0.0.0:0 [1] Trying to join...", " 1.0.0.0:0 [1] Node 2.0.0.0:0 joined at time 1",
        " 1.0.0.0:0 [2] Node 3.0.0.0:0 joined at time 2", " 2.0.0.0:0 [2] Node 3.0.0.0:0 joined at time 2",
        " 3.0.0.0:0 [2] Node 1.0.0.0:0 joined at time 2", " 3.0.0.0:0 [3] Node 3.0.0.0:0 joined at time 3",
        " 3.0.0.0:0 [100] Node failed at time=100", " 3.0.0.0:0 [100] Node failed at time = 100", " 9.0.0.0:0 [5] Node left early",
        " 1.0.0.0:0 [126] Node 3.0.0.0:0 removed at time 126", " 2.0.0.0:0 [126] Node 3.0.0.0:0 removed at time 126",
        " 2.0.0.0:0 [130] Node 1.0.0.0:0 removed at time 130"))
    assert log.count() == 10
    found = membership.membership_audit(log).drop("peers", "introduced")
    assert rows(found) == [
        ("1.0.0.0:0", 1, 1, False, True, False), ("2.0.0.0:0", 1, 0, False, True, True),
        ("3.0.0.0:0", 2, 2, True, True, True)]


def audited(lines, *events):
    log = membership.parse_membership_log(lines(*(
        f" {o} [9] Node failed at time = 9" if a == "failed" else f" {o} [9] Node {m} {a} at time 9" for o, m, a in events)))
    return {r.member: r for r in membership.membership_audit(log).collect()}


def test_audit_of_several_failures(lines):
    names = "abcd"
    joined = [(o, m, "joined") for o in names for m in names if o != m]
    failed = [("c", "c", "failed"), ("d", "d", "failed")]
    gone = [(o, m, "removed") for o in "ab" for m in "cd"]
    both = audited(lines, *joined, *failed, *gone)
    assert all(r.introduced and r.complete and r.accurate for r in both.values())
    assert (both["c"].peers, both["c"].removed_by, both["a"].peers) == (2, 2, 1)
    # a silent survivor is missing, and a failed node does not stand in for it
    silent = audited(lines, *joined, *failed, *(g for g in gone if g[0] == "a"), ("d", "c", "removed"))
    assert not silent["c"].complete and silent["c"].removed_by == 1
    # a node that only others saw joining counts as a peer
    unheard = audited(lines, ("a", "b", "joined"), ("a", "z", "joined"), ("b", "b", "failed"), ("a", "b", "removed"))
    assert not unheard["b"].complete and unheard["b"].peers == 2 and not unheard["b"].introduced
    # who failed later may still have removed a live node
    assert not audited(lines, *joined, *failed, ("d", "a", "removed"))["a"].accurate
