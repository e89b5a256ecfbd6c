"""Parameter files: airport lists, airport pairs and itinerary requests, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skytally.functions.parse import to_date
from skytally.functions.text import split_whitespace


def parse_key_list(lines: DataFrame, name: str = "origin") -> DataFrame:
    """One key per line (column ``value``); blank lines are skipped, repeated keys are kept once."""
    return lines.select(F.trim("value").alias(name)).where(F.col(name) != "").distinct()


def parse_pair_list(lines: DataFrame, first: str = "origin", second: str = "dest") -> DataFrame:
    """Two keys per line, separated by white space; lines with fewer fields are skipped."""
    fields = lines.select(split_whitespace(F.col("value")).alias("f")).where(F.size("f") >= 2)
    return fields.select(F.col("f")[0].alias(first), F.col("f")[1].alias(second)).distinct()


def parse_trip_requests(lines: DataFrame) -> DataFrame:
    """Requests ``X Y Z date``; malformed lines are skipped."""
    # Generators of one row, through which no filter is moved: each line is cut once, and each date read once.
    fields = lines.select(F.explode(F.array(split_whitespace(F.col("value")))).alias("f")).where(F.size("f") >= 4)
    requests = fields.select(F.inline(F.array(F.struct(
        F.col("f")[0].alias("x"), F.col("f")[1].alias("y"), F.col("f")[2].alias("z"),
        to_date(F.col("f")[3]).alias("date1"),
    ))))
    return requests.where(F.col("date1").isNotNull()).distinct()


def read_key_list(spark: SparkSession, path: str, name: str = "origin") -> DataFrame:
    return parse_key_list(spark.read.text(path), name)


def read_pair_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_pair_list(spark.read.text(path))


def read_trip_requests(spark: SparkSession, path: str) -> DataFrame:
    return parse_trip_requests(spark.read.text(path))
