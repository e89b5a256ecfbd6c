"""Stream sources behind one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(
    servers: str,
    topic: str,
    from_start: bool = True,
    max_records_per_trigger: int | None = None,
    min_partitions: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: where to start, the rate cap per trigger, and the consumer group if one is set."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_start else "latest",
        "failOnDataLoss": "true",
    }
    if max_records_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_records_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if group is not None:
        options["kafka.group.id"] = group
    return options


def file_options(max_files_per_trigger: int | None = None, name_pattern: str | None = None) -> dict[str, str]:
    options = {}
    if max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if name_pattern is not None:
        options["pathGlobFilter"] = name_pattern
    return options


def stream_source(
    spark: SparkSession,
    kind: str,
    path: str | None = None,
    schema: StructType | None = None,
    **options,
) -> DataFrame:
    """A stream of text lines or records.

    ``kind`` is ``kafka`` (column ``value``, text; keywords of :func:`kafka_options`), ``text`` or a file format
    such as ``parquet`` or ``csv`` (folder, schema, and keywords of :func:`file_options`).
    """
    if kind == "kafka":
        reader = spark.readStream.format("kafka").options(**kafka_options(**options))
        return reader.load().selectExpr("CAST(value AS STRING) AS value")
    reader = spark.readStream.format(kind).options(**file_options(**options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
