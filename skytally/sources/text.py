"""Text lines, adjacency lists, ratings, and numeric tables for learning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skytally.schemas import MOVIES, RATINGS


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Column ``value``, one row per line."""
    return spark.read.text(paths)


def parse_adjacency(lines: DataFrame) -> DataFrame:
    """Rows (src, dst, position) from lines ``src: dst dst ...`` or ``src dst dst ...``.

    A source without targets keeps one row whose ``dst`` is NULL, so that no vertex is lost.
    """
    ids = F.transform(
        F.filter(F.split("value", r"[:\s]+"), lambda token: token != ""), lambda token: token.try_cast("bigint")
    )
    src, count = F.get("ids", F.lit(0)).alias("src"), F.size("ids")
    link = lambda dst, position: F.struct(src, dst.alias("dst"), position.alias("position"))
    links = F.transform(F.slice("ids", 2, count), link)
    alone = F.array(link(F.lit(None).cast("bigint"), F.lit(None).cast("int")))
    return lines.select(ids.alias("ids")).select(F.inline(F.when(count > 1, links).when(count == 1, alone)))


def read_adjacency(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_adjacency(read_lines(spark, paths))


def read_ratings(spark: SparkSession, paths: str | list[str], sep: str = "::") -> DataFrame:
    """User, movie, rating, time. The separator may have several characters, so commas in fields are data."""
    return spark.read.schema(RATINGS).option("sep", sep).csv(paths)


def read_movies(spark: SparkSession, paths: str | list[str], sep: str = "::") -> DataFrame:
    return spark.read.schema(MOVIES).option("sep", sep).csv(paths)


def _doubles(count: int) -> list[T.StructField]:
    return [T.StructField(f"x{i}", T.DoubleType()) for i in range(1, count + 1)]


def read_labeled_points(spark: SparkSession, paths: str | list[str], features: int) -> DataFrame:
    """Columns x1..xN and, last, ``label``."""
    schema = T.StructType(_doubles(features) + [T.StructField("label", T.DoubleType())])
    return spark.read.schema(schema).csv(paths)


def read_titled_points(spark: SparkSession, paths: str | list[str], features: int) -> DataFrame:
    """A quoted ``title`` followed by x1..xN."""
    schema = T.StructType([T.StructField("title", T.StringType())] + _doubles(features))
    return spark.read.schema(schema).csv(paths)
