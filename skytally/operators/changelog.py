"""Create / read / update / delete logs (key, seq, op, value).

Whether an operation succeeds depends on the operations on its key before it. A key may own a large share of the
log, so its history is cut into ranges of ``seq``: whole numbers, unique in the log, hence at most ``width`` rows per
(key, range). Ranges are worked on side by side and only their one-row summaries are ordered per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

RANGE_WIDTH = 1_000_000


def _ranged(log: DataFrame, width: int) -> DataFrame:
    known = log.where(F.col("key").isNotNull() & F.col("seq").isNotNull())
    return known.withColumn("_range", F.expr(f"seq div {width}")).where(F.col("_range").isNotNull())


def changelog_state(log: DataFrame, width: int = RANGE_WIDTH) -> DataFrame:
    """``(key, seq, value)`` of the keys that exist at the end.

    A repeated create keeps the first value; an update counts only while the key exists.
    """
    writes = _ranged(log.where(F.col("op") != "READ"), width)
    op, entry = F.col("op"), F.struct("seq", "value")
    deleted = F.max(F.when(op == "DELETE", F.col("seq"))).over(Window.partitionBy("key", "_range"))
    open_ = F.col("_deleted").isNull() | (F.col("seq") > F.col("_deleted"))
    ranges = writes.withColumn("_deleted", deleted).groupBy("key", "_range").agg(
        F.max("_deleted").alias("deleted"),
        F.min(F.when(open_ & (op == "CREATE"), entry)).alias("created"),
        F.max(F.when(open_ & (op == "UPDATE"), entry)).alias("updated"),
    )
    last_delete = F.max(F.when(F.col("deleted").isNotNull(), F.col("_range"))).over(Window.partitionBy("key"))
    since = ranges.withColumn("_since", last_delete).where(F.col("_since").isNull() | (F.col("_range") >= F.col("_since")))
    lives = since.groupBy("key").agg(F.min("created").alias("created"), F.max("updated").alias("updated"))
    current = F.when(F.col("updated.seq") > F.col("created.seq"), F.col("updated")).otherwise(F.col("created"))
    return lives.where(F.col("created").isNotNull()).withColumn("_now", current).select(
        "key", F.col("_now.seq").alias("seq"), F.col("_now.value").alias("value")
    )


def changelog_audit(log: DataFrame, width: int = RANGE_WIDTH) -> DataFrame:
    """Every operation with ``success``: a create always succeeds, the others need an existing key."""
    ranged = _ranged(log.select("key", "seq", "op"), width).repartition("key", "_range")  # shared by both branches
    decides = F.col("op").isin("CREATE", "DELETE")
    last = ranged.groupBy("key", "_range").agg(F.max_by("op", F.when(decides, F.col("seq"))).alias("_last"))
    earlier_ranges = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("key", "_range", F.last("_last", ignorenulls=True).over(earlier_ranges).alias("_carried"))
    earlier_rows = Window.partitionBy("key", "_range").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn(
        "_before", F.last(F.when(decides, F.col("op")), ignorenulls=True).over(earlier_rows)
    )
    exists = F.coalesce("_before", "_carried") == "CREATE"
    success = F.coalesce((F.col("op") == "CREATE") | exists, F.lit(False))
    return within.join(carried, ["key", "_range"]).select("key", "seq", "op", success.alias("success"))


def audit_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("op", "success").agg(F.count(F.lit(1)).alias("n"))
