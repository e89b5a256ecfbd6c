"""Flight questions: popularity, on-time rates, delays."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skytally.functions.numeric import geometric_pmf, min_max_scale, poisson_pmf
from skytally.plans.joins import restrict_to
from skytally.plans.ranking import top_k, top_k_per_group, with_position

RATE_DIGITS = 9   # rates are rounded before they are ranked, so equal rates tie
DELAY_DIGITS = 6


def airport_popularity(flights: DataFrame) -> DataFrame:
    """How often each airport occurs as origin or destination; one scan, counted before the exchange."""
    ends = flights.select(F.explode(F.array("origin", "dest")).alias("airport"))
    return ends.where(F.col("airport").isNotNull()).groupBy("airport").agg(F.count(F.lit(1)).alias("popularity"))


def popularity_order():
    return F.desc("popularity"), F.desc("airport")


def top_airports(flights: DataFrame, n: int = 10) -> DataFrame:
    return top_k(airport_popularity(flights), n, *popularity_order())


def rank_airports(flights: DataFrame) -> DataFrame:
    """All airports with their 0-based popularity position ``id``."""
    return with_position(airport_popularity(flights), *popularity_order())


def on_time_rate(flights: DataFrame, keys: list[str], indicator: str) -> DataFrame:
    """Share of flights per key that were not late, over the flights whose ``indicator`` (0/1) is known."""
    known = flights.dropna(subset=[*keys, indicator])
    late, all_ = F.sum(F.col(indicator).cast("bigint")), F.count(F.lit(1))
    return known.groupBy(*keys).agg(F.round((all_ - late) / all_, RATE_DIGITS).alias("perf"))


def on_time_by_weekday(flights: DataFrame) -> DataFrame:
    return on_time_rate(flights, ["day_of_week"], "arr_delayed")


def rank_weekdays(flights: DataFrame) -> DataFrame:
    """Weekdays from the most to the least punctual, ties by the later day."""
    return with_position(on_time_by_weekday(flights), F.desc("perf"), F.desc("day_of_week"))


def on_time_by_origin_airline(flights: DataFrame, origins: DataFrame | None = None) -> DataFrame:
    """Departure performance per airport and airline, optionally for a list of origins."""
    if origins is not None:
        flights = restrict_to(flights, origins, ["origin"])
    return on_time_rate(flights, ["origin", "airline_id"], "dep_delayed")


def on_time_by_pair_airline(flights: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Arrival performance per airport pair and airline, optionally for a list of pairs."""
    if pairs is not None:
        flights = restrict_to(flights, pairs, ["origin", "dest"])
    return on_time_rate(flights, ["origin", "dest", "airline_id"], "arr_delayed")


def top_airlines_from(rates: DataFrame, n: int = 10) -> DataFrame:
    """Best airlines of each origin."""
    return top_k_per_group(rates, ["origin"], n, F.desc("perf"), F.desc("airline_id"))


def top_airlines_between(rates: DataFrame, n: int = 10) -> DataFrame:
    """Best airlines of each airport pair."""
    return top_k_per_group(rates, ["origin", "dest"], n, F.desc("perf"), F.desc("airline_id"))


def mean_delay(flights: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Mean arrival delay in minutes per airport pair."""
    if pairs is not None:
        flights = restrict_to(flights, pairs, ["origin", "dest"])
    known = flights.dropna(subset=["origin", "dest", "arr_delay_minutes"])
    total = F.sum(F.col("arr_delay_minutes").cast("bigint"))
    return known.groupBy("origin", "dest").agg(F.round(total / F.count(F.lit(1)), DELAY_DIGITS).alias("mean_delay"))


def zipf_compare(popularity: DataFrame, p: float = 0.5, mean: float = 0.999, digits: int = 9) -> DataFrame:
    """Rank-frequency table next to Zipf, geometric and Poisson expectations.

    Input: (airport, popularity). The extremes needed for scaling are one-row subqueries over the numbered table,
    not a second pass over the flights.
    """
    ranked = with_position(popularity, *popularity_order()).withColumn("rank", F.col("id") + 1)
    first = ranked.agg(F.max("popularity")).scalar()
    last = ranked.agg(F.min("popularity")).scalar()
    count = ranked.agg(F.count(F.lit(1))).scalar()
    measured = ranked.select(
        "airport", "popularity", "rank", first.alias("_first"), last.alias("_last"), count.alias("_count")
    )
    zipf = F.col("_first") / F.col("rank")
    return measured.select(
        "airport", "popularity", "rank",
        F.round(zipf, digits).alias("zipf"),
        F.round(min_max_scale(F.col("popularity").cast("double"), F.col("_last"), F.col("_first")), digits)
        .alias("popularity_scaled"),
        F.round(min_max_scale(zipf, F.col("_first") / F.col("_count"), F.col("_first").cast("double")), digits)
        .alias("zipf_scaled"),
        F.round(geometric_pmf(F.col("rank"), p), digits).alias("geometric"),
        F.round(poisson_pmf(F.col("rank"), mean), digits).alias("poisson"),
    )
