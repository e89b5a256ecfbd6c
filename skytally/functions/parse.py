"""Tolerant parsing of text fields: what cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def present(text: Column) -> Column:
    """Trimmed text; blank text and the missing mark ``NA`` are NULL."""
    trimmed = F.trim(text)
    return F.when((trimmed != "") & (trimmed != "NA"), trimmed)


def to_int(text: Column) -> Column:
    """Whole number of a field, also of one written like ``4.00``. Values beyond int are NULL."""
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def to_date(text: Column) -> Column:
    """``yyyy-MM-dd`` date. Text of another shape is not handed to the parser, which is slow to say no."""
    return F.when(text.rlike(r"^[+-]?\d{4,}-\d\d-\d\d$"), F.try_to_date(text, "yyyy-MM-dd"))
