"""Batch sinks: text results, serving tables, loaders and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skytally.functions.text import split_whitespace, strip_character
from skytally.plans.joins import restrict_to
from skytally.schemas import all_text


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Tab-separated text, replacing what is there. ``single_file`` is for results as small as a top-k report."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("sep", "\t").csv(path)


def read_tsv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path)


def write_serving_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a serving table. With ``partition_by``, every partition value has a folder of its own.

    The rows of a value meet in one task, so that its folder holds one file. AQE splits the value over several tasks
    where it exceeds the advisory size, and puts small values together.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_serving_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A serving table. ``schema`` states the types of partition keys, which folder names do not tell."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_serving_keys(spark: SparkSession, path: str, keys: DataFrame, schema=None) -> DataFrame:
    """The rows of a serving table whose partition key is in ``keys``; folders of other keys are not read.

    Folders outside the keys' range are left out when the query is planned. Those between are left out when it runs,
    by the keys that were broadcast: the planner does so only where it expects the keys to be few, and takes the range
    for a sign of that.
    """
    rows = read_serving_table(spark, path, schema)
    ends = keys.agg(*[end(name).alias(f"{end.__name__} {name}") for name in keys.columns for end in (F.min, F.max)]).first()
    for name in keys.columns:
        rows = rows.where(F.col(name).between(F.lit(ends[f"min {name}"]), F.lit(ends[f"max {name}"])))
    return restrict_to(rows, keys, keys.columns)


def write_results(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Predictions or cluster members, one file per task."""
    df.write.mode("overwrite").format(fmt).save(path)


def parse_whitespace_rows(lines: DataFrame, columns: list[str], *kept: str) -> DataFrame:
    """Result lines split on white space, colons removed, as an all-text table with the given columns (and ``kept``)."""
    fields = F.transform(split_whitespace(F.col("value")), lambda field: strip_character(field))
    rows = lines.where(F.trim("value") != "").select(fields.alias("f"), *kept)
    return rows.select(*[F.get("f", F.lit(i)).alias(field.name) for i, field in enumerate(all_text(columns))], *kept)


def load_whitespace_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return parse_whitespace_rows(spark.read.text(path), columns)


def load_last_rows(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The table of :func:`load_whitespace_table` with the last row of each key, which is the first column.

    Files count in the order of their paths, rows in the order of their lines: by file, by place of the split in it,
    and by place of the line in the split.
    """
    place = F.struct(
        "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", place.alias("_place"))
    rows = parse_whitespace_rows(lines, columns, "_place")
    return latest_by_key(rows, columns[:1], "_place").drop("_place")


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    """Column names of a table, one per line, in file order. Such a file has one partition."""
    lines = spark.read.text(path, wholetext=True).selectExpr("explode(split(value, '\\n')) AS line").collect()
    return [row.line.strip() for row in lines if row.line.strip()]


def latest_by_key(rows: DataFrame, keys: list[str], *sequence: str) -> DataFrame:
    """The last written row of each key; rows of equal ``sequence`` are decided by their values.

    Rows are reduced before the exchange, so a key with many rows costs no more than others.
    """
    values = [*sequence, *(c for c in rows.columns if c not in keys and c not in sequence)]
    newest = F.max(F.struct(*values)).alias("_row")
    latest = rows.groupBy(*keys).agg(newest)
    return latest.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], *sequence: str) -> DataFrame:
    """``existing`` with every row of ``incoming`` put at its key; the later row of a key stays."""
    return latest_by_key(existing.unionByName(incoming), keys, *sequence)


def non_blank_lines(lines: DataFrame) -> DataFrame:
    """Messages to publish: every line that is not empty."""
    return lines.where(F.length("value") > 0).select("value")


def publish(lines: DataFrame, target: str, kind: str = "text", **options: str) -> None:
    """Write the non-empty lines as messages, one task per input split.

    ``kind`` is ``kafka`` (``target`` is the topic) or a file format (``target`` is a folder).
    """
    messages = non_blank_lines(lines)
    if kind == "kafka":
        messages.write.format("kafka").option("topic", target).options(**options).save()
    else:
        messages.write.mode("append").format(kind).options(**options).save(target)


def put_cells(cells: DataFrame) -> DataFrame:
    """Current cells of a wide table: of each (row, family, qualifier) the value put last."""
    return latest_by_key(cells, ["row_key", "family", "qualifier"], "seq")


def family_rows(cells: DataFrame, families: dict[str, list[str]]) -> DataFrame:
    """One row per row key with a struct per family, for the declared qualifiers.

    A single aggregation with partial results: neither the cells of a row nor those of a column are collected.
    """
    def latest(family: str, qualifier: str) -> Column:
        here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
        return F.max_by("value", F.when(here, F.col("seq"))).alias(qualifier)

    flat = cells.groupBy("row_key").agg(*[
        F.struct(*[latest(family, qualifier) for qualifier in qualifiers]).alias(family)
        for family, qualifiers in families.items()
    ])
    return flat
