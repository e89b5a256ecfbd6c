"""Iterative graph questions over edges (src, dst).

Each round is a few joins and aggregations whose result is checkpointed in the shared folder, so a lost executor
costs one round at most, and plans do not grow. Only one-row summaries reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from skytally.plans.durable import durable
from skytally.plans.joins import ROWS_PER_TASK, lookup_join

UNREACHABLE = 2147483647  # fixed value: hop count of a vertex that cannot be reached, in the integer form

_FEW = 10_000  # rows of a level or of all levels that may be broadcast: what larger ones add up to is shuffled

_MERGE_LEVELS = 16  # BFS levels after which the visited set is written as one table


def _sizes(pairs: DataFrame) -> tuple[int, int]:
    """Number of (hi, lo) pairs and of their upper ends."""
    row = pairs.groupBy("hi").count().agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("ends")).first()
    return row.n or 0, row.ends


def connected_components(
    vertices: DataFrame, edges: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(id, component)``: the smallest vertex id of the weakly connected component.

    Alternating star contraction: every edge is kept as (hi, lo). First each edge is moved to the smallest neighbour
    of its lower end, then all lower neighbours of a vertex are tied to the smallest one. Once every vertex has one
    lower neighbour the edges are trees, each a component with its smallest vertex as root, and moving alone flattens
    them. The number of edges never grows, the number of rounds is logarithmic, and the hubs that arise are joined by
    :func:`lookup_join`.
    """
    state = durable(
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
        .distinct()
    )
    total, ends = _sizes(state)
    while total > 0:
        lowest = state.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m"))
        moves = lookup_join(state, lowest, "lo", total, "left", rows_per_task)
        target = F.coalesce("m", "lo").alias("lo")
        if total == ends:
            moved = durable(moves.select("hi", target, F.col("m").isNotNull().alias("moved")))
            if moved.where("moved").isEmpty():
                break
            state = moved.select("hi", "lo")
            continue
        moved = durable(moves.select("hi", target).distinct())
        lowest = moved.groupBy("hi").agg(F.min("lo").alias("m"))
        tie = F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        state = durable(
            lookup_join(moved, lowest, "hi", total, "inner", rows_per_task)
            .select(F.inline(tie))
            .where("hi <> lo")
            .distinct()
        )
        total, ends = _sizes(state)
    roots = state.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return vertices.select("id").join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def shortest_paths(
    vertices: DataFrame,
    edges: DataFrame,
    source: int,
    integer_unreachable: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``(id, hops)``: fewest directed edges from ``source``; NULL (or the integer mark) where there is no path.

    Breadth-first: each round joins the edges with the newest level only and writes only the next level. A level of
    few rows is broadcast by Spark, others are shuffled, so that what goes through the driver does not grow with them.
    """
    by_size = lambda df, rows: df if rows <= _FEW else df.hint("merge")

    links = durable(edges.where("src <> dst").select(F.col("src").alias("id"), "dst").distinct())
    total = links.count()
    level = durable(vertices.where(F.col("id") == source).select("id", F.lit(0).alias("hops")))
    levels, hops = [level], 0
    size = seen = level.count()
    while size:
        hops += 1
        reached = lookup_join(links, by_size(level.select("id"), size), "id", total, "inner", rows_per_task)
        visited = by_size(reduce(DataFrame.unionByName, levels), seen)
        level = durable(
            reached.select(F.col("dst").alias("id")).distinct()
            .join(visited, "id", "left_anti")
            .select("id", F.lit(hops).alias("hops"))
        )
        size = level.count()
        seen += size
        levels.append(level)
        if len(levels) > _MERGE_LEVELS:
            levels = [durable(reduce(DataFrame.unionByName, levels))]
    found = by_size(reduce(DataFrame.unionByName, levels), seen)
    result = F.coalesce("hops", F.lit(UNREACHABLE)) if integer_unreachable else F.col("hops")
    return vertices.select("id").join(found, "id", "left").select("id", result.alias("hops"))
