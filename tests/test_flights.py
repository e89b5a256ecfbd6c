import datetime

from pyspark.sql import functions as F

from skytally.operators import flights as fl, serving, trips
from skytally.plans.inspect import plan_text
from tests.conftest import rows

FLIGHTS = "origin STRING, dest STRING, airline_id STRING, arr_delayed INT, dep_delayed INT, arr_delay_minutes INT, day_of_week INT"


def flights(spark, *records):
    return spark.createDataFrame(list(records), FLIGHTS)


def test_popularity_counts_both_ends_and_skips_missing_airports(spark):
    df = flights(spark, ("A", "B", "1", 0, 0, 0, 1), ("A", "A", "1", 0, 0, 0, 1), (None, "B", "1", 0, 0, 0, 1),
                 ("C", None, "1", 0, 0, 0, 1))
    assert rows(fl.airport_popularity(df)) == [("A", 3), ("B", 2), ("C", 1)]


def test_top_airports_breaks_ties_by_the_later_key(spark):
    df = flights(spark, ("A", "B", "1", 0, 0, 0, 1), ("C", "D", "1", 0, 0, 0, 1))
    assert rows(fl.top_airports(df, 1), "kept") == [("D", 1)]
    assert rows(fl.top_airports(df, 3), "kept") == [("D", 1), ("C", 1), ("B", 1)]
    assert fl.top_airports(df, 10).count() == 4
    assert "TakeOrderedAndProject" in plan_text(fl.top_airports(df))


def test_rates_exclude_missing_indicators(spark):
    df = flights(spark, ("A", "B", "1", 0, 1, 0, 1), ("A", "B", "1", 1, None, 0, 1), ("A", "B", "1", None, 0, 0, 2),
                 ("A", "B", "1", 1, 1, 0, 3), ("A", "B", "1", 0, 1, 0, 4), ("A", "B", "1", 0, 1, 0, None))
    assert rows(fl.on_time_by_weekday(df)) == [(1, 0.5), (3, 0.0), (4, 1.0)]
    assert rows(fl.rank_weekdays(df).select("id", "day_of_week")) == [(0, 4), (1, 1), (2, 3)]
    assert rows(fl.on_time_by_origin_airline(df)) == [("A", "1", 0.2)]


def test_top_airlines_keep_ten_per_group_with_ties_by_the_later_airline(spark):
    many = [("A", "B", f"{n:02}", 0, n % 2, 0, 1) for n in range(11)] + [("X", "B", "7", 0, 1, 0, 1)]
    df = flights(spark, *many)
    origins = spark.createDataFrame([("A",)], "origin STRING")
    top = fl.top_airlines_from(fl.on_time_by_origin_airline(df, origins))
    order = ["10", "08", "06", "04", "02", "00", "09", "07", "05", "03"]
    assert rows(top.orderBy("rank").select("rank", "airline_id"), "kept") == list(enumerate(order, 1))
    plan = plan_text(top, "simple")
    assert plan.count("WindowGroupLimit") >= 2 and "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_pairs_and_mean_delay(spark):
    df = flights(spark, ("A", "B", "1", 0, 0, 10, 1), ("A", "B", "2", 1, 0, 5, 1), ("A", "B", "2", 0, 0, None, 1),
                 ("B", "A", "1", 0, 0, 7, 1), ("A", "C", "1", 0, 0, 2_000_000_000, 1), ("A", "C", "1", 0, 0, 2_000_000_000, 1))
    pairs = spark.createDataFrame([("A", "B"), ("A", "C"), ("Q", "R")], "origin STRING, dest STRING")
    assert rows(fl.mean_delay(df, pairs)) == [("A", "B", 7.5), ("A", "C", 2e9)]
    assert rows(fl.mean_delay(df)) == [("A", "B", 7.5), ("A", "C", 2e9), ("B", "A", 7.0)]
    assert rows(fl.on_time_by_pair_airline(df, pairs)) == [("A", "B", "1", 1.0), ("A", "B", "2", 0.5), ("A", "C", "1", 1.0)]
    table = serving.mean_delay_table(fl.mean_delay(df))
    assert rows(table.select("id", "origin", "dest")) == [(0, "A", "C"), (1, "A", "B"), (2, "B", "A")]


def test_zipf(spark):
    popularity = spark.createDataFrame([("A", 8), ("B", 4), ("C", 2)], "airport STRING, popularity BIGINT")
    found = {r["rank"]: r for r in fl.zipf_compare(popularity).collect()}
    assert [found[i].zipf for i in (1, 2, 3)] == [8.0, 4.0, 2.666666667]
    assert [found[i].popularity_scaled for i in (1, 2, 3)] == [1.0, 0.333333333, 0.0]
    assert [found[i].zipf_scaled for i in (1, 2, 3)] == [1.0, 0.25, 0.0]
    assert [found[i].geometric for i in (1, 2, 3)] == [0.25, 0.125, 0.0625]
    assert [found[i].poisson for i in (1, 2, 3)] == [0.367879257, 0.183755689, 0.061190644]


# --- itineraries ------------------------------------------------------------------------------------------------------

DAY1, DAY3 = datetime.date(2006, 7, 30), datetime.date(2006, 8, 1)
TRIPS = "origin STRING, dest STRING, flight_date DATE, dep_time INT, arr_time INT, flight_id STRING"
REQUEST = "x STRING, y STRING, z STRING, date1 DATE"


def trip_flights(spark):
    return spark.createDataFrame([
        ("A", "B", DAY1, 1200, 1330, "f2"),   # noon counts for leg 0
        ("A", "B", DAY1, 700, 1330, "f1"),    # equal arrival: the smaller id
        ("A", "B", DAY1, 1201, 1300, "late"),
        ("A", "B", DAY1, None, 1, "unknown"),
        ("B", "C", DAY3, 1200, 1500, "g1"),   # noon counts for leg 1
        ("B", "C", DAY3, 1159, 1400, "early"),
        ("B", "D", DAY3, 1300, 9999, "never"),
        ("A", "E", DAY1, 800, 900, "one leg"),
        ("B", "C", DAY1, 1300, 1400, "wrong day"),
    ], TRIPS)


def trip_requests(spark):
    return spark.createDataFrame(
        [("A", "B", "C", DAY1), ("A", "B", "C", DAY1), ("A", "B", "D", DAY1), ("A", "E", "F", DAY1)], REQUEST)


def test_trips(spark):
    expected = [(DAY1, "A", "B", 1330, "f1", DAY3, "B", "C", 1500, "g1")]
    for few in (None, True, False):
        assert rows(trips.find_trips(trip_flights(spark), trip_requests(spark), few)) == expected


def test_trip_legs(spark):
    legs = trips.request_legs(trip_requests(spark)).where("z = 'C'")
    assert rows(legs.select("leg", "origin", "dest", "flight_date")) == [(0, "A", "B", DAY1), (1, "B", "C", DAY3)]
    best = trips.leg_best(trips.best_flights(trip_flights(spark)), trip_requests(spark))
    assert rows(best.select("z", "leg", "flight_id")) == [("C", 0, "f1"), ("C", 1, "g1"), ("D", 0, "f1"), ("F", 0, "one leg")]
    found = trips.leg_candidates(trip_flights(spark), trip_requests(spark)).select("leg", "flight_id")
    assert rows(found) == [(0, "f1"), (0, "f2"), (0, "one leg"), (1, "g1"), (1, "never")]


def test_one_leg_key_held_by_most_rows_is_reduced_before_the_join(spark):
    plan = plan_text(trips.find_trips(trip_flights(spark), trip_requests(spark), few=False), "simple")
    assert "partial_min" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_wanted_legs_are_reduced_in_one_exchange(spark):
    requests = spark.createDataFrame(
        [("a", "b", "c", "2020-01-01"), ("a", "b", "d", "2020-01-01"), ("a", "b", "c", "2020-01-01"), ("b", "c", "a", "2020-01-03")],
        "x STRING, y STRING, z STRING, day STRING").select("x", "y", "z", F.to_date("day").alias("date1"))
    legs = trips.wanted_legs(requests)
    assert plan_text(legs, "simple").count("Exchange") == 1
    expected = trips.request_legs(requests).select("leg", *trips.LEG_KEY).distinct()
    assert sorted(map(tuple, legs.collect())) == sorted(map(tuple, expected.collect())) and legs.count() == 5
