"""Declared schemas of the inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Column order of a cleaned flight file, which has no header. Order and names are fixed values.
FLIGHT_COLUMNS = (
    "origin", "dest", "airline_id", "airline_code", "arr_delayed", "dep_delayed", "arr_delay_minutes",
    "flight_date", "day_of_week", "crs_dep_time", "arr_time", "dep_time", "flight_id",
)

FLIGHT_RAW = _strings(*FLIGHT_COLUMNS)

FLIGHT_INT_COLUMNS = (
    "arr_delayed", "dep_delayed", "arr_delay_minutes", "day_of_week", "crs_dep_time", "arr_time", "dep_time",
)

# Source column -> cleaned column for the on-time performance files. Fixed values.
CLEAN_COLUMNS = {
    "Origin": "origin",
    "Dest": "dest",
    "AirlineID": "airline_id",
    "Carrier": "airline_code",
    "ArrDel15": "arr_delayed",
    "DepDel15": "dep_delayed",
    "ArrDelayMinutes": "arr_delay_minutes",
    "FlightDate": "flight_date",
    "DayOfWeek": "day_of_week",
    "CRSDepTime": "crs_dep_time",
    "ArrTime": "arr_time",
    "DepTime": "dep_time",
    "FlightNum": "flight_id",
}

RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("rated_at", T.LongType()),
])

MOVIES = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

CELLS = T.StructType([
    T.StructField("row_key", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("qualifier", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])


def all_text(columns: list[str]) -> T.StructType:
    """Schema of a table whose columns come from a list and are all text."""
    return _strings(*columns)
