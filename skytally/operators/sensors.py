"""Sensor messages ``time sensor value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Alarm bounds when none are given.
MIN_VALUE = -100
MAX_VALUE = 100


def parse_messages(lines: DataFrame) -> DataFrame:
    """Typed messages; lines with fewer than three fields or without a whole number are dropped."""
    fields = lines.select(F.split("value", " ").alias("f"))
    field = lambda i: F.get("f", F.lit(i))
    message = F.struct(field(0).alias("ts"), field(1).alias("sensor"), field(2).try_cast("int").alias("value"))
    return fields.select(F.inline(F.when(F.size("f") >= 3, F.array(message)))).where(F.col("value").isNotNull())


def alarms(messages: DataFrame, low: int = MIN_VALUE, high: int = MAX_VALUE) -> DataFrame:
    """Messages below ``low`` or above ``high``; a value on a bound is no alarm."""
    return messages.where((F.col("value") < low) | (F.col("value") > high))
