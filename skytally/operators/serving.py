"""Result tables for serving: ranked rows with a dense position ``id``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skytally.operators.flights import popularity_order
from skytally.plans.ranking import with_position


def ranked_table(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``id`` 0, 1, ... in ``order`` and the single group ``grp`` 0."""
    return with_position(rows, *order).withColumn("grp", F.lit(0))


def top_airports_table(top: DataFrame) -> DataFrame:
    return ranked_table(top, *popularity_order())


def weekday_table(rates: DataFrame) -> DataFrame:
    return ranked_table(rates, F.desc("perf"), F.desc("day_of_week"))


def zipf_table(popularity: DataFrame) -> DataFrame:
    return ranked_table(popularity, *popularity_order())


def airlines_from_table(top: DataFrame) -> DataFrame:
    """Kept airlines of all origins, numbered by performance across origins."""
    rows = top.select("origin", F.col("airline_id").alias("from_airline"), "perf")
    return with_position(rows, F.desc("perf"), F.asc("origin"), F.desc("from_airline"))


def airlines_between_table(top: DataFrame) -> DataFrame:
    rows = top.select("origin", "dest", F.col("airline_id").alias("airline"), "perf")
    return with_position(rows, F.desc("perf"), F.asc("origin"), F.asc("dest"), F.desc("airline"))


def mean_delay_table(means: DataFrame) -> DataFrame:
    return with_position(means, F.desc("mean_delay"), F.asc("origin"), F.asc("dest"))
