"""Flight lines with a verdict: what is wrong with a row, counted in the pass that reads it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from skytally.functions.parse import present
from skytally.schemas import FLIGHT_COLUMNS, FLIGHT_INT_COLUMNS
from skytally.sources.flights import typed_columns

GOOD, BLANK, SHORT, UNREADABLE = "good", "blank", "short", "unreadable"
VERDICTS = (GOOD, BLANK, SHORT, UNREADABLE)
_MALFORMED = "_malformed"

# Lines and fields that need no parser, which is most of them: those of other shapes are left to it.
_NOT_PLAIN = r"[\"\\\x00-\x1F]"
_PLAIN_INT = r"^([+-]?[0-9]{1,9}|NA|)$"
_PLAIN_DATE = r"^([1-9][0-9]{3}-(0[1-9]|1[0-2])-(0[1-9]|1[0-9]|2[0-8])|NA|)$"


def judge_lines(lines: DataFrame) -> DataFrame:
    """Adds the typed flight columns and ``verdict`` to lines (column ``value``); other columns stay.

    ``blank``: nothing but white space. ``short``: not as many fields as there are columns. ``unreadable``: a number or
    date that is there but is none. All other rows are ``good``; a field that is missing or says so is no fault.
    """
    schema = ", ".join(f"{column} STRING" for column in (*FLIGHT_COLUMNS, _MALFORMED))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED,
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    plain = F.when(~F.col("value").rlike(_NOT_PLAIN), F.split("value", ","))
    cut = lines.select(F.struct(*lines.columns).alias("_line"), plain.alias("_cut"), "value")
    parsed = cut.select("_line", "_cut", F.when(F.col("_cut").isNull(), F.from_csv("value", schema, options)).alias("_raw"))
    fields = [F.coalesce(F.trim(F.get("_cut", F.lit(i))), F.col(f"_raw.{c}")).alias(c) for i, c in enumerate(FLIGHT_COLUMNS)]
    wrong = (F.size("_cut") != len(FLIGHT_COLUMNS)) | F.col(f"_raw.{_MALFORMED}").isNotNull()
    told = parsed.select("_line", *fields, F.coalesce(wrong, F.lit(False)).alias(_MALFORMED))
    typed = dict(zip(FLIGHT_COLUMNS, typed_columns()))
    lost = reduce(Column.__or__, [
        F.when(F.coalesce(F.col(c).rlike(_PLAIN_DATE if c == "flight_date" else _PLAIN_INT), F.lit(True)), False).otherwise(
            present(F.col(c)).isNotNull() & typed[c].isNull()) for c in (*FLIGHT_INT_COLUMNS, "flight_date")])
    verdict = (
        F.when(F.coalesce(F.trim("_line.value"), F.lit("")) == "", BLANK).when(F.col(_MALFORMED), SHORT)
        .when(lost, UNREADABLE).otherwise(GOOD))
    return told.select("_line.*", *typed.values(), verdict.alias("verdict"))


def read_judged_flights(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Flights of headerless CSV files with ``file``, ``value`` (the line) and ``verdict``; no row is left out."""
    return judge_lines(spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file")))


def observed(judged: DataFrame, counts: Observation) -> DataFrame:
    """Count the verdicts while the rows are read for whatever is asked of them: ``counts.get`` has them afterwards."""
    return judged.observe(counts, *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS])


def good_flights(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("verdict") == GOOD).select(*FLIGHT_COLUMNS)


def rejects(judged: DataFrame) -> DataFrame:
    """``(file, verdict, value)`` of the rows with a fault."""
    return judged.where(F.col("verdict") != GOOD).select("file", "verdict", "value")


def verdict_counts(judged: DataFrame, *by: str) -> DataFrame:
    """``(..., verdict, n)``."""
    return judged.groupBy(*(by or ("file",)), "verdict").agg(F.count(F.lit(1)).alias("n"))
