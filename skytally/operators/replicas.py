"""Questions about replicated keys: quorums and placement on a hash ring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skytally.functions.numeric import RING_SIZE, ring_position

# Copies per key and the number of them that decide.
REPLICAS = 3
QUORUM = 2


def _voters(replica: str | None, vote: Column) -> Column:
    """How many votes are cast: by distinct replicas, where their column is named."""
    return F.count_if(vote) if replica is None else F.count_distinct(F.when(vote, F.col(replica)))


def quorum_read(replicas: DataFrame, quorum: int = QUORUM, replica: str | None = None) -> DataFrame:
    """``(key, value, success)`` from replica answers (key, value): the value that enough replicas agree on.

    Absent and empty answers do not count. With the column ``replica``, one that gives an answer twice counts once, and
    an answer without a replica does not count.
    """
    votes = replicas.groupBy("key", "value").agg(_voters(replica, F.lit(True)).alias("n"))
    agreed = F.when((F.col("n") >= quorum) & (F.col("value").cast("string") != ""), F.col("value"))
    read = votes.groupBy("key").agg(F.max(agreed).alias("value"))
    return read.withColumn("success", F.col("value").isNotNull())


def quorum_write(acks: DataFrame, quorum: int = QUORUM, replica: str | None = None) -> DataFrame:
    """``(key, acks, success)`` from replica replies (key, ok); each ``replica``, where it is named, counts once."""
    counted = acks.groupBy("key").agg(_voters(replica, F.col("ok")).alias("acks"))
    return counted.withColumn("success", F.col("acks") >= quorum)


def ring_table(nodes: DataFrame, ring_size: int = RING_SIZE, replicas: int = REPLICAS) -> DataFrame:
    """``(position, replica, node)`` for every ring position; empty when there are too few nodes.

    A position belongs to the first node at or after it, then to the nodes that follow on the ring. Per position only
    ``replicas`` nodes matter, so at most ring_size * replicas entries are brought together here.
    """
    entry = F.struct("position", "node")
    at_position = Window.partitionBy("position").orderBy("node")
    placed = nodes.select("node", ring_position(F.col("node"), ring_size).alias("position")).distinct()
    kept = placed.withColumn("_n", F.row_number().over(at_position)).where(F.col("_n") <= replicas)
    ring = kept.agg(F.array_sort(F.collect_list(entry)).alias("ring")).where(F.size("ring") >= replicas)
    spots = ring.select("ring", F.size("ring").alias("size"), F.posexplode("ring").alias("i", "spot"))
    previous = F.get("ring", F.col("i") - 1)["position"]
    start = F.when(F.col("i") == 0, F.lit(0)).otherwise(previous + 1)
    tail = F.element_at("ring", -1)["position"] + 1
    own = F.when(start <= F.col("spot.position"), F.sequence(start, F.col("spot.position"))).otherwise(F.array())
    wrapped = F.when((F.col("i") == 0) & (tail < ring_size), F.sequence(tail, F.lit(ring_size - 1))).otherwise(F.array())
    members = F.transform(
        F.sequence(F.lit(0), F.lit(replicas - 1)),
        lambda r: F.struct(r.alias("replica"), F.get("ring", (F.col("i") + r) % F.col("size"))["node"].alias("node")),
    )
    owned = spots.select(F.explode(F.concat(own, wrapped)).alias("position"), members.alias("members"))
    return owned.select("position", F.inline("members"))


def ring_placement(keys: DataFrame, nodes: DataFrame, ring_size: int = RING_SIZE) -> DataFrame:
    """``(key, replica, node)``. The ring table has a fixed size, so it is broadcast and keys are not shuffled."""
    placed = keys.select("key", ring_position(F.col("key"), ring_size).alias("position"))
    return placed.join(F.broadcast(ring_table(nodes, ring_size)), "position").select("key", "replica", "node")


def ring_balance(keys: DataFrame, nodes: DataFrame, ring_size: int = RING_SIZE) -> DataFrame:
    """``(node, keys, copies)``: keys owned and copies held per node; idle nodes have zeros.

    Keys are counted per position first.
    """
    loads = keys.groupBy(ring_position(F.col("key"), ring_size).alias("position")).agg(F.count(F.lit(1)).alias("n"))
    held = loads.join(F.broadcast(ring_table(nodes, ring_size)), "position").groupBy("node").agg(
        F.sum(F.when(F.col("replica") == 0, F.col("n")).otherwise(0)).alias("keys"), F.sum("n").alias("copies")
    )
    return nodes.where("node IS NOT NULL").select("node").distinct().join(held, "node", "left").select(
        "node", F.coalesce("keys", F.lit(0)).alias("keys"), F.coalesce("copies", F.lit(0)).alias("copies"))
