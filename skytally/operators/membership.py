"""Heartbeats and membership logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skytally.plans.durable import durable

# Ticks without progress until a member is suspected, and further ticks until it is removed.
FAIL_TICKS = 5
REMOVE_TICKS = 20

# Fixed values, the log lines (observer, tick in brackets, text):
#   1.0.0.0:0 [2] Node 3.0.0.0:0 joined at time 2
#   1.0.0.0:0 [126] Node 3.0.0.0:0 removed at time 126
#   3.0.0.0:0 [100] Node failed at time=100
#   3.0.0.0:0 [100] Node failed at time = 100
CHANGES = ("joined", "removed")


def last_advance(heartbeats: DataFrame) -> DataFrame:
    """``(member, heartbeat, tick)``: the largest heartbeat and the tick at which it was first seen.

    Only a larger heartbeat counts as a sign of life. Works on streams too.
    """
    best = F.max(F.struct("heartbeat", (-F.col("tick")).alias("_neg"))).alias("_best")
    return heartbeats.groupBy("member").agg(best).select(
        "member", F.col("_best.heartbeat").alias("heartbeat"), (-F.col("_best._neg")).alias("tick")
    )


def heartbeat_status(advances: DataFrame, now: int | Column) -> DataFrame:
    """Adds ``gap`` and ``status`` (alive, suspect, removed) at tick ``now``."""
    now = now if isinstance(now, Column) else F.lit(now)
    gap = F.col("gap")
    status = F.when(gap <= FAIL_TICKS, "alive").when(gap <= FAIL_TICKS + REMOVE_TICKS, "suspect").otherwise("removed")
    return advances.withColumn("gap", now - F.col("tick")).withColumn("status", status)


def parse_membership_log(lines: DataFrame) -> DataFrame:
    """``(observer, tick, member, action)``; for a ``failed`` line the observer is the member. Other lines drop out.

    A line is split once and its words tell what it is. Matching lines come out of a generator and not of a filter,
    which the planner would push below the split and so split the line for every word it looks at.
    """
    word = lambda i: F.get("w", F.lit(i))
    failed = (word(3) == "failed") & (word(4) == "at") & F.startswith(word(5), F.lit("time"))
    changed = word(4).isin(*CHANGES) & (word(5) == "at") & (word(6) == "time")
    entry = F.struct(
        word(0).alias("observer"),
        F.translate(word(1), "[]", "").try_cast("bigint").alias("tick"),
        F.when(failed, word(0)).otherwise(word(3)).alias("member"),
        F.when(failed, word(3)).otherwise(word(4)).alias("action"),
    )
    split = lines.select(F.split(F.trim("value"), " ").alias("w"))
    return split.select(F.inline(F.when((word(2) == "Node") & (failed | changed), F.array(entry))))


def membership_audit(log: DataFrame) -> DataFrame:
    """Per member: by how many other nodes its joining and removal were logged, whether it failed, and three verdicts.

    Nodes are all observers and all members seen joining; those that did not fail survive. ``removed_by`` counts
    surviving observers, ``peers`` the other survivors, silent ones too.
    ``introduced``: every other node logged the joining. ``complete``: a failed member was removed by every surviving
    peer. ``accurate``: only a failed member was removed, by whomever.
    The log is read once: what follows needs only the distinct pairs of nodes, which are kept.
    """
    pairs = durable(log.groupBy("member", "observer").agg(
        F.max((F.col("action") == "joined").cast("int")).alias("joined"),
        F.max((F.col("action") == "removed").cast("int")).alias("removed"),
        F.max((F.col("action") == "failed").cast("int")).alias("failed"),
    ))
    dead = pairs.where("failed = 1").select(F.col("member").alias("node"), F.lit(0).alias("_alive")).distinct()
    alive = F.coalesce("_alive", F.lit(1))
    named = pairs.select(F.col("observer").alias("node")).union(pairs.where("joined = 1").select("member"))
    nodes = named.distinct().join(dead, "node", "left").select("node", alive.alias("_alive"), F.lit(1).alias("_node"))
    total = nodes.agg(F.count(F.lit(1))).scalar()
    survivors = nodes.agg(F.coalesce(F.sum("_alive"), F.lit(0))).scalar()

    other = (F.col("observer") != F.col("member")).cast("int")
    judged = pairs.join(dead.withColumnRenamed("node", "observer"), "observer", "left")
    members = judged.groupBy(F.col("member").alias("node")).agg(
        F.sum(F.col("joined") * other).alias("joined_by"),
        F.sum(F.col("removed") * other * alive).alias("removed_by"),
        F.max(F.col("removed") * other).alias("_removed"),
        (F.max("failed") == 1).alias("failed"),
    )
    audited = members.join(nodes, "node", "left").select(
        F.col("node").alias("member"), "joined_by", "removed_by", "failed", "_removed",
        (survivors - F.coalesce("_alive", F.lit(0))).alias("peers"),
        (total - F.coalesce("_node", F.lit(0))).alias("_others"),
    )
    return audited.select(
        "member", "joined_by", "removed_by", "failed", "peers",
        (F.col("joined_by") >= F.col("_others")).alias("introduced"),
        (~F.col("failed") | (F.col("removed_by") >= F.col("peers"))).alias("complete"),
        (F.col("failed") | (F.col("_removed") == 0)).alias("accurate"),
    )
