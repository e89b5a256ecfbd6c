"""Top-k, per-group top-k and whole-table positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skytally.plans.durable import durable
from skytally.plans.joins import ROWS_PER_TASK

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def top_k(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows. Each task keeps n rows and only those are merged."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, groups: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group, with their 1-based ``rank``.

    The rank filter lets Spark limit each group before the exchange, so a task receives at most n rows per group
    and map task however large the group is.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def with_position(df: DataFrame, *order: Column, name: str = "id") -> DataFrame:
    """Number all rows 0, 1, 2, ... in ``order`` without passing them through one task.

    Rows are range-partitioned and sorted, numbered inside their partition, and shifted by the sizes of the
    partitions before. Only one row per partition meets in the unpartitioned window. The sorted rows are
    checkpointed because both branches must see the same partitions.
    """
    columns = df.columns
    ordered = durable(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    numbered = ordered.select(
        *columns,
        F.shiftright("_row", _ROW_BITS).alias("_part"),
        F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_within"),
    )
    sizes = numbered.groupBy("_part").agg((F.max("_within") + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return numbered.join(F.broadcast(offsets), "_part").select(
        *columns, (F.col("_before") + F.col("_within")).alias(name)
    )


def count_below(df: DataFrame, value: str, name: str = "rank") -> DataFrame:
    """For each row, how many rows have a strictly smaller ``value`` (ties share the number).

    Works on the histogram of values. ``value`` is a count over some other rows, so a total of E of them has fewer
    than sqrt(2 E) + 1 distinct values: that bounds both the unpartitioned window and the broadcast.
    """
    below = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    histogram = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = histogram.select(value, F.coalesce(F.sum("_n").over(below), F.lit(0)).alias(name))
    return df.join(F.broadcast(ranks), value).select(*df.columns, name)


def rank_below(df: DataFrame, value: str, name: str = "rank", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """For each row, how many rows have a strictly smaller ``value`` of any type that sorts (ties share the number).

    Equal values are counted first: however many rows share one, it is one row from there on. The distinct values are
    range-partitioned and summed up within their range; only one row per range meets in the unpartitioned window.
    Values of more than ``rows_per_task`` rows, at most one per that many rows, hand out their number by broadcast, the
    others by a join. NULL has no number and counts for nothing; NaN is larger than every number.
    """
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = durable(counts.orderBy(value).withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy("_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.sum("_n").alias("_size")).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    ranks = placed.withColumn("_within", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(
        F.broadcast(offsets), "_part").select(value, "_n", (F.col("_before") + F.col("_within")).alias(name))
    if placed.where(F.col("_n") > rows_per_task).isEmpty():
        ranked = known.join(ranks.drop("_n"), value)
    else:
        ranks = durable(ranks)
        hot = F.broadcast(ranks.where(F.col("_n") > rows_per_task).drop("_n"))
        others = ranks.where(F.col("_n") <= rows_per_task).drop("_n")
        ranked = known.join(hot, value).unionByName(known.join(hot, value, "left_anti").join(others, value))
    rankless = df.where(F.col(value).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    return ranked.select(*df.columns, name).unionByName(rankless)
