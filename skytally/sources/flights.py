"""Flight files."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skytally.functions.parse import present, to_date, to_int
from skytally.schemas import CLEAN_COLUMNS, FLIGHT_COLUMNS, FLIGHT_INT_COLUMNS, FLIGHT_RAW, all_text


def _typed(column: str):
    text = present(F.col(column))
    if column in FLIGHT_INT_COLUMNS:
        text = to_int(text)
    elif column == "flight_date":
        text = to_date(text)
    return text.alias(column)


def typed_columns() -> list:
    """The typed columns of flights from the all-text ones; unreadable fields are NULL."""
    return [_typed(column) for column in FLIGHT_COLUMNS]


def type_flights(raw: DataFrame) -> DataFrame:
    """Typed flights from the all-text columns. Works on streams too."""
    return raw.select(*typed_columns())


def read_flights(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Flights of headerless CSV files. Blank lines are skipped, missing trailing fields are NULL."""
    raw = (
        spark.read.schema(FLIGHT_RAW)
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(paths)
    )
    return type_flights(raw)


def parse_flight_lines(lines: DataFrame) -> DataFrame:
    """Flights from text lines (column ``value``), e.g. of a message stream. Blank lines are skipped."""
    schema = ", ".join(f"{column} STRING" for column in FLIGHT_COLUMNS)
    parsed = F.from_csv("value", schema, {"mode": "PERMISSIVE"}).alias("flight")
    return type_flights(lines.where(F.trim("value") != "").select(parsed).select("flight.*"))


def read_manifest(spark: SparkSession, manifest: str | list[str]) -> list[str]:
    """Paths listed in a manifest, one per line. The list is the argument of a read, so it goes to the driver."""
    lines = spark.read.text(manifest).select(F.trim("value").alias("path")).where(F.col("path") != "")
    return [row.path for row in lines.orderBy("path").collect()]


def read_flights_from_manifest(spark: SparkSession, manifest: str | list[str]) -> DataFrame:
    """One DataFrame over all files that a manifest lists."""
    return read_flights(spark, read_manifest(spark, manifest))


# With these settings each file is one task, whatever its size.
_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}


def _first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a task. It ends there, so the rest of the file is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def files_by_header(spark: SparkSession, paths: str | list[str]) -> list[list[str]]:
    """The files of each header (their first line that is not blank), found by one job over all files.

    A task reads the first lines of one file. The paths come to the driver, as the argument of a read; of the headers
    only hashes do. Files without a line have none.
    """
    lines = spark.read.text(paths).where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("header"))
    before = {name: spark.conf.get(name) for name in _FILE_A_TASK}
    try:
        for name, value in _FILE_A_TASK.items():
            spark.conf.set(name, value)
        found = lines.mapInArrow(_first_row, "path STRING, header STRING").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    groups: dict[str, list[str]] = {}
    for path, header in sorted(found):
        groups.setdefault(header, []).append(unquote(path))
    return list(groups.values())


def read_on_time_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """On-time performance files (with header), projected to the cleaned flight columns, all text.

    Files may name their columns in different orders: those of equal headers are read together, by their own names.
    Only the wanted columns are parsed.
    """
    groups = files_by_header(spark, paths)
    if not groups:
        return spark.createDataFrame([], all_text(list(CLEAN_COLUMNS.values())))
    read = [spark.read.option("header", True).option("inferSchema", False).csv(files).select(
        *[F.col(name).alias(clean) for name, clean in CLEAN_COLUMNS.items()]) for files in groups]
    return functools.reduce(DataFrame.unionByName, read)
