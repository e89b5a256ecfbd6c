"""Two-leg itineraries X -> Y -> Z, the second leg two days after the first.

The best flight of a leg depends only on its airports, its date and its half of the day. It is therefore found once
per (origin, dest, date) by an aggregation that reduces before the exchange; requests are joined to that result, not
to the flights. However many requests ask for one leg, and however many flights serve it, no task pairs the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skytally.plans.durable import durable
from skytally.plans.joins import fits_broadcast, restrict_to

LAYOVER_DAYS = 2     # fixed value: days from the first to the second leg
NOON = 1200          # fixed value: leg 0 departs at or before it, leg 1 at or after it
NO_ARRIVAL = 9999    # fixed value: only arrivals before it count

LEG_KEY = ["origin", "dest", "flight_date"]


def _both_legs() -> Column:
    first = F.struct(
        F.lit(0).alias("leg"), F.col("x").alias("origin"), F.col("y").alias("dest"), F.col("date1").alias("flight_date"))
    second = F.struct(
        F.lit(1).alias("leg"), F.col("y").alias("origin"), F.col("z").alias("dest"),
        F.date_add("date1", LAYOVER_DAYS).alias("flight_date"))
    return F.array(first, second)


def wanted_legs(requests: DataFrame) -> DataFrame:
    """The distinct legs of all requests. They are reduced at once, not after the requests, of which there are more."""
    return requests.select(F.inline(_both_legs())).distinct()


def request_legs(requests: DataFrame) -> DataFrame:
    """Both legs of each request (x, y, z, date1); a repeated request counts once."""
    distinct = requests.select("x", "y", "z", "date1").distinct()
    return distinct.select("x", "y", "z", "date1", F.inline(_both_legs()))


def _in_half(leg: Column) -> Column:
    return F.when(leg == 0, F.col("dep_time") <= NOON).otherwise(F.col("dep_time") >= NOON)


def usable_flights(flights: DataFrame) -> DataFrame:
    return flights.dropna(subset=[*LEG_KEY, "dep_time", "arr_time", "flight_id"])


def leg_candidates(flights: DataFrame, requests: DataFrame) -> DataFrame:
    """Flights that serve a requested leg, once per leg number.

    Requests that share a leg share its candidates, so the result has at most two rows per flight.
    """
    legs = durable(wanted_legs(requests))  # asked for its size, then joined
    if fits_broadcast(legs):
        legs = F.broadcast(legs)
    joined = usable_flights(flights).join(legs, LEG_KEY)
    return joined.where(_in_half(F.col("leg"))).select("leg", *LEG_KEY, "dep_time", "arr_time", "flight_id")


def best_flights(flights: DataFrame) -> DataFrame:
    """Earliest arrival per (origin, dest, date) for either leg, as structs ``best0`` and ``best1``.

    Equal arrivals are decided by the smaller flight id.
    """
    arrival = F.struct("arr_time", "flight_id")
    usable = usable_flights(flights).where(F.col("arr_time") < NO_ARRIVAL)
    return usable.groupBy(*LEG_KEY).agg(
        F.min(F.when(_in_half(F.lit(0)), arrival)).alias("best0"),
        F.min(F.when(_in_half(F.lit(1)), arrival)).alias("best1"),
    )


def only_requested(flights: DataFrame, requests: DataFrame, few: bool | None = None) -> DataFrame:
    """Drop flights on no requested leg, when the requests are ``few`` enough to be sent to every task.

    By default this is found out by counting them. With many requests the flights go on as they are: they are reduced
    to one row per leg before any join.
    """
    if few is None:
        few = fits_broadcast(requests)
    if not few:
        return flights
    legs = wanted_legs(requests).select(*LEG_KEY).distinct()
    return restrict_to(flights, legs, LEG_KEY)


def leg_best(best: DataFrame, requests: DataFrame) -> DataFrame:
    """Best flight of each leg of each request, where there is one. ``best`` is from :func:`best_flights`."""
    chosen = F.when(F.col("leg") == 0, F.col("best0")).otherwise(F.col("best1"))
    found = request_legs(requests).join(best, LEG_KEY).withColumn("_best", chosen).where(F.col("_best").isNotNull())
    return found.select(
        "x", "y", "z", "date1", "leg", *LEG_KEY,
        F.col("_best.arr_time").alias("arr_time"), F.col("_best.flight_id").alias("flight_id"),
    )


def best_trips(best: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per request both of whose legs can be flown."""
    first = best.where(F.col("best0").isNotNull()).select(
        F.col("origin").alias("x"), F.col("dest").alias("y"), F.col("flight_date").alias("date1"),
        F.col("best0.arr_time").alias("time1"), F.col("best0.flight_id").alias("flight_id1"),
    )
    second = best.where(F.col("best1").isNotNull()).select(
        F.col("origin").alias("y"), F.col("dest").alias("z"), F.col("flight_date").alias("date2"),
        F.col("best1.arr_time").alias("time2"), F.col("best1.flight_id").alias("flight_id2"),
    )
    asked = requests.select("x", "y", "z", "date1", F.date_add("date1", LAYOVER_DAYS).alias("date2")).distinct()
    return asked.join(first, ["x", "y", "date1"]).join(second, ["y", "z", "date2"]).select(
        "date1", F.col("x").alias("origin1"), F.col("y").alias("dest1"), "time1", "flight_id1",
        "date2", F.col("y").alias("origin2"), F.col("z").alias("dest2"), "time2", "flight_id2",
    )


def find_trips(flights: DataFrame, requests: DataFrame, few: bool | None = None, store: bool = False) -> DataFrame:
    """Best itinerary of each request over a table of flights.

    Both legs are looked up in the best flights; with ``store`` these are found at once, and only once.
    """
    best = best_flights(only_requested(flights, requests, few))
    return best_trips(durable(best) if store else best, requests)
