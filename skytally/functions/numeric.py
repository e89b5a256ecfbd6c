"""Numeric column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

RING_SIZE = 512  # fixed value: number of positions on the placement ring


def min_max_scale(value: Column, low: Column, high: Column) -> Column:
    """``value`` mapped from [low, high] to [0, 1]; NULL when low equals high."""
    return F.try_divide(value - low, high - low)


def geometric_pmf(k: Column, p: float) -> Column:
    """Probability of ``k`` failures before the first success."""
    return F.lit(p) * F.pow(F.lit(1.0 - p), k)


def log_factorial(k: Column) -> Column:
    """ln(k!) for any k >= 0: exact factorials up to 20, Stirling's series beyond (error below 1e-11)."""
    x = (k + 1).cast("double")
    series = (
        (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    )
    return F.when(k <= 20, F.ln(F.factorial(F.least(k.cast("int"), F.lit(20))))).otherwise(series)


def poisson_pmf(k: Column, mean: float) -> Column:
    """Probability of ``k`` events; computed in logarithms, so large k do not overflow."""
    return F.exp(-F.lit(mean) + k * math.log(mean) - log_factorial(k))


def cosine_similarity(first: Column, second: Column, index: str = "user_index", value: str = "rating") -> Column:
    """Cosine of two sparse vectors: arrays of structs with an ``index`` that does not repeat and a ``value``.

    For two given vectors; all similarities to one item are an aggregation, see the recommender.
    """
    values = F.map_from_entries(F.transform(first, lambda e: F.struct(e[index], e[value])))
    other = lambda e: F.coalesce(F.try_element_at(values, e[index]), F.lit(0))
    dot = F.aggregate(second, F.lit(0.0), lambda s, e: s + other(e) * e[value])
    squares = lambda vector: F.aggregate(vector, F.lit(0.0), lambda s, e: s + e[value] * e[value])
    return F.try_divide(dot, F.sqrt(squares(first)) * F.sqrt(squares(second)))


def ring_position(key: Column, ring_size: int = RING_SIZE) -> Column:
    """Stable position of a key on the ring, from the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % ring_size
