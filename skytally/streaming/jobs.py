"""The streaming questions: batch transforms over streams, ranked when the input is used up.

Every job takes a stream of flights, lines or messages, runs over the available input, and returns the result as a
DataFrame. ``root`` is the folder of its checkpoint and tables: given again, the job continues with new input only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skytally.operators import flights as fl, membership, sensors, trips, words
from skytally.plans.ranking import with_position
from skytally.streaming.runner import run_append, run_to_report, run_to_table


def stream_top_airports(flights: DataFrame, n: int = 10, root: str | None = None) -> DataFrame:
    counts = fl.airport_popularity(flights)
    report = run_to_report(counts, "airport", "popularity", n, *fl.popularity_order(), root=root)
    return report.last(flights.sparkSession)


def stream_on_time_weekday(flights: DataFrame, root: str | None = None) -> DataFrame:
    rates = run_to_table(fl.on_time_by_weekday(flights), ["day_of_week"], root)
    return with_position(rates.current(flights.sparkSession), F.desc("perf"), F.desc("day_of_week"))


def stream_top_airlines_from(
    flights: DataFrame, origins: DataFrame, n: int = 10, root: str | None = None
) -> DataFrame:
    rates = run_to_table(fl.on_time_by_origin_airline(flights, origins), ["origin", "airline_id"], root)
    return fl.top_airlines_from(rates.current(flights.sparkSession), n)


def stream_top_airlines_between(
    flights: DataFrame, pairs: DataFrame, n: int = 10, root: str | None = None
) -> DataFrame:
    rates = run_to_table(fl.on_time_by_pair_airline(flights, pairs), ["origin", "dest", "airline_id"], root)
    return fl.top_airlines_between(rates.current(flights.sparkSession), n)


def stream_mean_delay(flights: DataFrame, pairs: DataFrame, root: str | None = None) -> DataFrame:
    means = run_to_table(fl.mean_delay(flights, pairs), ["origin", "dest"], root)
    return means.current(flights.sparkSession)


def stream_best_trips(flights: DataFrame, requests: DataFrame, root: str | None = None) -> DataFrame:
    """State: the best flight per airports, date and half of the day, whatever is requested.

    Requests are joined when the state is read, so a root can be continued with another list.
    """
    best = run_to_table(trips.best_flights(flights), trips.LEG_KEY, root)
    return trips.best_trips(best.current(flights.sparkSession), requests)


def stream_sensor_alarms(
    lines: DataFrame, low: int = sensors.MIN_VALUE, high: int = sensors.MAX_VALUE, root: str | None = None
) -> DataFrame:
    table = run_append(sensors.alarms(sensors.parse_messages(lines), low, high), root)
    return table.changes(lines.sparkSession).select(*table.schema.names)


def stream_word_count(lines: DataFrame, root: str | None = None) -> DataFrame:
    counts = run_to_table(words.word_count(words.sentence_words(lines)), ["word"], root)
    return counts.current(lines.sparkSession)


def stream_word_count_normalized(lines: DataFrame, root: str | None = None) -> DataFrame:
    normalized = words.normalized_words(words.sentence_words(lines))
    return run_to_table(words.word_count(normalized), ["word"], root).current(lines.sparkSession)


def stream_top_words(lines: DataFrame, n: int = 10, root: str | None = None) -> DataFrame:
    counts = words.word_count(words.normalized_words(words.sentence_words(lines)))
    report = run_to_report(counts, "word", "n", n, F.desc("n"), F.asc("word"), root=root)
    return report.last(lines.sparkSession)


def stream_heartbeat_status(heartbeats: DataFrame, now: int, root: str | None = None) -> DataFrame:
    advances = run_to_table(membership.last_advance(heartbeats), ["member"], root)
    return membership.heartbeat_status(advances.current(heartbeats.sparkSession), now)
