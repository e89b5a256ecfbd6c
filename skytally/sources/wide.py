"""Wide rows stored as cells (row_key, family, qualifier, value): scans by column and by row range."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def scan_column(cells: DataFrame, family: str, qualifier: str | None = None) -> DataFrame:
    """Cells of one column, or of a whole family, of all rows."""
    wanted = F.col("family") == family
    if qualifier is not None:
        wanted = wanted & (F.col("qualifier") == qualifier)
    return cells.where(wanted)


def scan_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """Cells of the rows from ``start`` (included) to ``stop`` (excluded); equal bounds mean that one row."""
    if start == stop:
        return cells.where(F.col("row_key") == start)
    return cells.where((F.col("row_key") >= start) & (F.col("row_key") < stop))
