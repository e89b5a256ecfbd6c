"""Join shapes that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# A list of at most so many rows and bytes is shipped to every task.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

# A key with more rows than this is joined by broadcast instead of in one shuffle task.
ROWS_PER_TASK = 5_000_000


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: eight a column, and what texts and nested values add."""
    size = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return size


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes. No more than one row beyond is looked at."""
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return size.n <= max_rows and (size.bytes or 0) <= max_bytes


def restrict_to(rows: DataFrame, wanted: DataFrame, on: list[str], anti: bool = False) -> DataFrame:
    """Rows whose key is (or with ``anti`` is not) in a parameter list.

    A list of checked size is broadcast, so the rows are filtered in place. A longer list is joined by shuffle,
    where AQE splits an oversized key.
    """
    keys = wanted.select(*on)
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    return rows.join(keys, on, "left_anti" if anti else "left_semi")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    total_rows: int | None = None,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` with a ``lookup`` that has one row per key.

    When ``total_rows`` shows that no key can exceed ``rows_per_task`` this is a plain join. Otherwise the keys above
    that size, at most one per ``rows_per_task`` rows, are matched by broadcast and only the others are shuffled.
    ``how`` is ``inner`` or ``left``. ``counts`` are ``(key, count)`` of at least these rows, if they are known already.
    """
    if total_rows is not None and total_rows <= rows_per_task:
        return rows.join(lookup, key, how)
    hot = (rows.groupBy(key).count() if counts is None else counts).where(F.col("count") > rows_per_task).select(key)
    hot_lookup = lookup.join(F.broadcast(hot), key, "left_semi")
    hot_rows = rows.join(F.broadcast(hot), key, "left_semi")
    cold_rows = rows.join(F.broadcast(hot), key, "left_anti")
    return hot_rows.join(F.broadcast(hot_lookup), key, how).unionByName(cold_rows.join(lookup, key, how))
