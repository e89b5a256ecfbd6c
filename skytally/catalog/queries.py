"""One query per operator, each over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skytally.catalog import inputs
from skytally.catalog.inputs import Tables
from skytally.functions import text as text_functions
from skytally.functions.sql import register_functions
from skytally.operators import (
    changelog, flights as fl, graph, learn, links as lk, membership, recommend, replicas, sensors, serving, similar, trips,
    words,
)
from skytally.plans.durable import durable, scratch_path
from skytally.plans.joins import restrict_to
from skytally.plans.ranking import rank_below
from skytally.schemas import CLEAN_COLUMNS, FLIGHT_COLUMNS
from skytally.sinks import tables as sink
from skytally.sinks.stored import KeyedTable, cell_table, read_wide_table, write_wide_table
from skytally.sources import flights as flight_files, judged, params, text as text_files, wide
from skytally.sources.streams import stream_source
from skytally.streaming import jobs, live
from skytally.streaming.progress import run_logged
from skytally.streaming.runner import RunningTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

AIRLINE_FIELDS = ["origin", "dest", "airline_id", "arr_delayed"]
TRIP_FIELDS = ["origin", "dest", "flight_date", "dep_time", "arr_time", "flight_id"]
SOURCE_MOVIE = 1
DETECTION_LAG = 12  # ticks
AUDIT_LAG = 100  # sequence numbers
SOURCE_VERTEX = 1
FAMILIES = {name: ["k", "value"] for name in ("click", "error", "purchase", "signup", "view")}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``build`` under its name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


# --- flights ----------------------------------------------------------------------------------------------------------

@query
def airport_popularity(t: Tables) -> DataFrame:
    return fl.airport_popularity(inputs.flights(t, ["origin", "dest"]))


@query
def top_airports(t: Tables) -> DataFrame:
    return fl.top_airports(inputs.flights(t, ["origin", "dest"]))


@query
def rank_airports_full(t: Tables) -> DataFrame:
    return fl.rank_airports(inputs.flights(t, ["origin", "dest"]))


@query
def ontime_by_weekday(t: Tables) -> DataFrame:
    return fl.on_time_by_weekday(inputs.flights(t, ["day_of_week", "arr_delayed"]))


@query
def rank_weekdays(t: Tables) -> DataFrame:
    return fl.rank_weekdays(inputs.flights(t, ["day_of_week", "arr_delayed"]))


@query
def ontime_by_origin_airline(t: Tables) -> DataFrame:
    return fl.on_time_by_origin_airline(inputs.flights(t, ["origin", "airline_id", "dep_delayed"]))


@query
def top_airlines_from_x(t: Tables) -> DataFrame:
    rates = fl.on_time_by_origin_airline(
        inputs.flights(t, ["origin", "airline_id", "dep_delayed"]), inputs.airport_list(t))
    return fl.top_airlines_from(rates)


@query
def ontime_by_pair_airline(t: Tables) -> DataFrame:
    return fl.on_time_by_pair_airline(inputs.flights(t, AIRLINE_FIELDS))


@query
def top_airlines_xy(t: Tables) -> DataFrame:
    return fl.top_airlines_between(fl.on_time_by_pair_airline(inputs.flights(t, AIRLINE_FIELDS), inputs.pair_list(t)))


@query
def mean_delay_pair(t: Tables) -> DataFrame:
    return fl.mean_delay(inputs.flights(t, ["origin", "dest", "arr_delay_minutes"]))


@query
def semi_origin_list(t: Tables) -> DataFrame:
    rows = restrict_to(inputs.flights(t, ["origin", "flight_id"]), inputs.airport_list(t), ["origin"])
    return rows.select("origin", "flight_id")


@query
def semi_pair_list(t: Tables) -> DataFrame:
    rows = restrict_to(inputs.flights(t, ["origin", "dest", "flight_id"]), inputs.pair_list(t), ["origin", "dest"])
    return rows.select("origin", "dest", "flight_id")


@query
def trip_request_legs(t: Tables) -> DataFrame:
    return trips.request_legs(inputs.trip_requests(t))


@query
def trip_leg_candidates(t: Tables) -> DataFrame:
    return trips.leg_candidates(inputs.flights(t, TRIP_FIELDS), inputs.trip_requests(t))


@query
def trip_leg_best(t: Tables) -> DataFrame:
    return trips.leg_best(trips.best_flights(inputs.flights(t, TRIP_FIELDS)), inputs.trip_requests(t))


@query
def trip_best(t: Tables) -> DataFrame:
    return trips.find_trips(inputs.flights(t, TRIP_FIELDS), inputs.trip_requests(t), few=False, store=True)


@query
def zipf_compare(t: Tables) -> DataFrame:
    return fl.zipf_compare(fl.airport_popularity(inputs.flights(t, ["origin", "dest"])))


# --- flight files -----------------------------------------------------------------------------------------------------

def _file_columns(flights: DataFrame) -> DataFrame:
    """All columns of a cleaned flight file, as text."""
    full = flights.withColumn("airline_code", F.col("airline_id")).withColumn("crs_dep_time", F.col("dep_time"))
    return full.select(*[F.col(c).cast("string").alias(c) for c in FLIGHT_COLUMNS])


def _flight_lines(t: Tables) -> DataFrame:
    """Lines of a cleaned flight file, missing fields as NA, with the year of the flight."""
    rows = _file_columns(inputs.flights(t))
    line = F.concat_ws(", ", *[F.coalesce(c, F.lit("NA")) for c in FLIGHT_COLUMNS])
    return rows.select(line.alias("value"), F.substring("flight_date", 1, 4).alias("year"))


@query
def src_flight_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "flights")
    _flight_lines(t).select("value").write.text(path)
    return flight_files.read_flights(t.spark, path)


@query
def src_manifest(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "by_year")
    lines = _flight_lines(t)
    lines.write.partitionBy("year").text(f"{root}/files")
    listed = lines.select(F.concat(F.lit(f"{root}/files/year="), "year").alias("value")).distinct()
    listed.write.text(f"{root}/manifest")
    flights = flight_files.read_flights_from_manifest(t.spark, f"{root}/manifest")
    return flights.groupBy("origin", "dest").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("arr_delay_minutes").alias("delay"))


@query
def src_flight_rejects(t: Tables) -> DataFrame:
    """Verdicts by year on flight files of which some lines are blank, cut short, or hold a date that is none."""
    path = scratch_path(t.spark, "faulty")
    flights = _file_columns(inputs.flights(t))
    fault = F.substring_index("flight_id", "-", 1).cast("bigint") % 10
    fields = [F.coalesce(c, F.lit("NA")) for c in FLIGHT_COLUMNS]
    date = FLIGHT_COLUMNS.index("flight_date")
    line = (
        F.when(fault == 0, F.lit("")).when(fault == 1, F.concat_ws(", ", *fields[:2]))
        .when(fault == 2, F.concat_ws(", ", *fields[:date], F.lit("never"), *fields[date + 1:]))
        .otherwise(F.concat_ws(", ", *fields)))
    flights.select(line.alias("value"), F.substring("flight_date", 1, 4).alias("year")).write.partitionBy("year").text(path)
    judged_rows = judged.read_judged_flights(t.spark, path)
    return judged.verdict_counts(judged_rows.withColumn("year", F.regexp_extract("file", r"year=(\d+)", 1)), "year")


@query
def clean_project(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "on_time")
    source = {clean: name for name, clean in CLEAN_COLUMNS.items()}
    named = _file_columns(inputs.flights(t)).select(
        F.substring("flight_date", 1, 4).alias("Year"), F.lit("N1").alias("TailNum"),
        *[F.col(c).alias(source[c]) for c in FLIGHT_COLUMNS])
    odd = F.pmod(F.xxhash64("FlightNum"), F.lit(2)) == 1
    named.where(~odd).write.option("header", True).csv(path)
    turned = named.where(odd).select(*reversed(named.columns))  # files of another header order
    turned.write.mode("append").option("header", True).csv(path)
    return flight_files.type_flights(flight_files.read_on_time_files(t.spark, path))


@query
def src_double_colon(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "movies")
    movies = inputs.movies(t)
    movies.select(F.format_string("%d::%s, again::%s", "movie_id", "title", "genres").alias("value")).write.text(path)
    return text_files.read_movies(t.spark, path)


@query
def params_key_list(t: Tables) -> DataFrame:
    """Best airlines of the airports in a file, in which some lines are blank and all are padded and repeated."""
    path = scratch_path(t.spark, "airports")
    airports = inputs.airport_list(t)
    lines = airports.select(F.explode(F.array(F.concat(F.lit("  "), "origin", F.lit(" ")), "origin", F.lit(" "))).alias("value"))
    lines.write.text(path)
    rates = fl.on_time_by_origin_airline(
        inputs.flights(t, ["origin", "airline_id", "dep_delayed"]), params.read_key_list(t.spark, path))
    return fl.top_airlines_from(rates)


@query
def params_pair_list(t: Tables) -> DataFrame:
    """Mean delays of the pairs in a file, in which some lines are one field short and some are repeated."""
    path = scratch_path(t.spark, "pairs")
    pairs = inputs.one_word(inputs.pair_list(t), "origin", "dest")
    lines = pairs.select(F.explode(F.array(
        F.concat_ws("\t ", "origin", "dest"), F.concat_ws(" ", "origin", "dest", F.lit("more")), "dest")).alias("value"))
    lines.write.text(path)
    flights = inputs.one_word(inputs.flights(t, ["origin", "dest", "arr_delay_minutes"]), "origin", "dest")
    return fl.mean_delay(restrict_to(flights, params.read_pair_list(t.spark, path), ["origin", "dest"]))


@query
def params_trip_requests(t: Tables) -> DataFrame:
    """Best trips of the requests in a file, which also has lines that are cut short or whose date is none."""
    path = scratch_path(t.spark, "requests")
    requests = inputs.one_word(inputs.trip_requests(t), "x", "y", "z")
    lines = requests.select(F.explode(F.array(
        F.concat_ws(" ", "x", "y", "z", "date1"), F.concat_ws(" ", "x", "y", "z"),
        F.concat_ws(" ", "z", "y", "x", F.lit("never")))).alias("value"))
    lines.write.text(path)
    flights = inputs.one_word(inputs.flights(t, TRIP_FIELDS), "origin", "dest")
    return trips.find_trips(flights, params.read_trip_requests(t.spark, path), few=False, store=True)


@query
def src_ratings(t: Tables) -> DataFrame:
    """Last ratings of a ``::`` file; of ratings of one day the highest counts."""
    path = scratch_path(t.spark, "ratings")
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date"))
    raw = inputs.raw_ratings(t).select(F.concat_ws("::", "user_id", "movie_id", "rating", day).alias("value"))
    raw.write.text(path)
    ratings = text_files.read_ratings(t.spark, path)
    return recommend.latest_ratings(ratings, "rated_at", "rating")


@query
def src_labeled_points(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "labeled")
    inputs.part_features(t).select("size", "price", "label").write.csv(path)
    return text_files.read_labeled_points(t.spark, path, 2)


@query
def src_titled_points(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "titled")
    title = F.concat("title", F.lit(", again")).alias("title")
    inputs.part_features(t).select(title, "size", "price").write.option("quoteAll", True).csv(path)
    return text_files.read_titled_points(t.spark, path, 2)


# --- sinks and serving tables -----------------------------------------------------------------------------------------

@query
def snk_tsv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "popularity")
    sink.write_tsv(fl.airport_popularity(inputs.flights(t, ["origin", "dest"])), path)
    return sink.read_tsv(t.spark, path, "airport STRING, popularity BIGINT")


@query
def serving_top_airports(t: Tables) -> DataFrame:
    return serving.top_airports_table(fl.top_airports(inputs.flights(t, ["origin", "dest"])))


@query
def serving_perf_days(t: Tables) -> DataFrame:
    return serving.weekday_table(fl.on_time_by_weekday(inputs.flights(t, ["day_of_week", "arr_delayed"])))


@query
def serving_topfromx(t: Tables) -> DataFrame:
    rates = fl.on_time_by_origin_airline(inputs.flights(t, ["origin", "airline_id", "dep_delayed"]))
    return serving.airlines_from_table(fl.top_airlines_from(rates))


@query
def serving_topxy(t: Tables) -> DataFrame:
    rates = fl.on_time_by_pair_airline(inputs.flights(t, AIRLINE_FIELDS))
    return serving.airlines_between_table(fl.top_airlines_between(rates))


@query
def serving_mean(t: Tables) -> DataFrame:
    return serving.mean_delay_table(fl.mean_delay(inputs.flights(t, ["origin", "dest", "arr_delay_minutes"])))


@query
def serving_findflight(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "findflight")
    found = trips.find_trips(inputs.flights(t, TRIP_FIELDS), inputs.trip_requests(t), few=False, store=True)
    sink.write_serving_table(found, path)
    return sink.read_serving_table(t.spark, path)


@query
def serving_zipf(t: Tables) -> DataFrame:
    return serving.zipf_table(fl.airport_popularity(inputs.flights(t, ["origin", "dest"])))


@query
def serving_select_topairports(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "top_airports")
    sink.write_serving_table(serving_top_airports(t), path, ["grp"])
    return sink.read_serving_table(t.spark, path).select("airport", "popularity", "id", "grp")


@query
def serving_read_topfromx(t: Tables) -> DataFrame:
    """The airlines of the listed airports, out of a table stored by origin."""
    path = scratch_path(t.spark, "topfromx")
    table = serving_topfromx(t)
    sink.write_serving_table(table, path, ["origin"])
    return sink.read_serving_keys(t.spark, path, inputs.airport_list(t), table.schema)


@query
def serving_read_topxy(t: Tables) -> DataFrame:
    """The airlines of the listed pairs, out of a table stored by origin and destination."""
    path = scratch_path(t.spark, "topxy")
    table = serving_topxy(t)
    sink.write_serving_table(table, path, ["origin", "dest"])
    return sink.read_serving_keys(t.spark, path, inputs.pair_list(t), table.schema)


@query
def load_whitespace_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "results")
    flights = inputs.flights(t, TRIP_FIELDS)
    line = F.concat_ws("  ", "flight_date", "origin", F.concat("dest", F.lit(":")), "arr_time", "flight_id")
    flights.select(line.alias("value")).write.text(path)
    return sink.load_whitespace_table(t.spark, path, ["date1", "origin1", "destination1", "arr_time1", "flight_id1"])


@query
def load_table_last_write(t: Tables) -> DataFrame:
    """Two folders of files, read in the order of their names: odd events are written after even ones."""
    root = scratch_path(t.spark, "writes")
    for name, odd in (("first", 0), ("second", 1)):
        written = t.events.where(F.col("event_id") % 2 == odd).repartition("user_id").sortWithinPartitions("event_id")
        written.select(F.concat_ws(" ", "user_id", "event_type", "event_id").alias("value")).write.text(f"{root}/{name}")
    return sink.load_last_rows(t.spark, [f"{root}/second", f"{root}/first"], ["user_id", "event_type", "event_id"])


@query
def upsert_last_write(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_type", "event_id", "value")
    earlier = events.where("event_type = 'signup'")
    later = events.where("event_type <> 'signup'")
    return sink.upsert(earlier, later, ["user_id", "event_type"], "event_id")


@query
def publish_lines(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "lines")
    t.documents.select(F.col("text").alias("value")).write.text(f"{root}/in")
    sink.publish(text_files.read_lines(t.spark, f"{root}/in"), f"{root}/out")
    published = t.spark.read.text(f"{root}/out")
    return published.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


@query
def stored_upsert(t: Tables) -> DataFrame:
    """Signups are put first, then all events; only the table's files are read back."""
    events = t.events.select("user_id", "event_type", "event_id", "value")
    table = KeyedTable(t.spark, scratch_path(t.spark, "stored"), events.schema, ["user_id", "event_type"], ["event_id"], 16)
    table.put(events.where("event_type = 'signup'"))
    table.put(events)
    return table.read()


@query
def stored_upsert_get(t: Tables) -> DataFrame:
    """The rows of some users' keys, from their buckets."""
    events = t.events.select("user_id", "event_type", "event_id", "value")
    table = KeyedTable(t.spark, scratch_path(t.spark, "stored"), events.schema, ["user_id", "event_type"], ["event_id"], 16)
    table.put(events)
    return table.get(events.where("user_id % 10 = 3").select("user_id", "event_type"))


@query
def stored_wide_put(t: Tables) -> DataFrame:
    """Cells put in two parts, the later ones first."""
    cells = inputs.cells(t)
    table = cell_table(t.spark, scratch_path(t.spark, "cells"), 16)
    table.put(cells.where("seq % 2 = 1"))
    table.put(cells.where("seq % 2 = 0"))
    return table.read().select("row_key", "family", "qualifier", "value")


def _stored_cells(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "wide")
    write_wide_table(inputs.cells(t), path, files=32)
    return read_wide_table(t.spark, path)


@query
def stored_scan_column(t: Tables) -> DataFrame:
    return wide.scan_column(_stored_cells(t), "click", "k").select("row_key", "value")


@query
def stored_scan_range(t: Tables) -> DataFrame:
    return wide.scan_range(_stored_cells(t), "row00010", "row00100")


@query
def stored_point_get(t: Tables) -> DataFrame:
    return wide.scan_range(_stored_cells(t), "row00010", "row00010")


@query
def wide_put_latest(t: Tables) -> DataFrame:
    rows = sink.family_rows(inputs.cells(t), FAMILIES)
    return rows.select("row_key", *[
        F.col(f"{family}.{name}").alias(f"{family}_{name}") for family, names in FAMILIES.items() for name in names])


@query
def wide_scan_column(t: Tables) -> DataFrame:
    return wide.scan_column(sink.put_cells(inputs.cells(t)), "click", "k").select("row_key", "value")


@query
def wide_scan_range(t: Tables) -> DataFrame:
    found = wide.scan_range(sink.put_cells(inputs.cells(t)), "row00010", "row00100")
    return found.select("row_key", "family", "qualifier", "value")


# --- text -------------------------------------------------------------------------------------------------------------

@query
def tokenize_delimiters(t: Tables) -> DataFrame:
    tokens = text_functions.tokenize_delimiters(F.col("text"))
    return t.documents.select("doc_id", F.array_join(tokens, " ").alias("words"))


@query
def tokenize_sentence(t: Tables) -> DataFrame:
    tokens = text_functions.tokenize_sentence(F.col("text"))
    return t.documents.select("doc_id", F.array_join(tokens, " ").alias("words"))


def _title_counts(t: Tables) -> DataFrame:
    lines = inputs.document_lines(t.documents)
    return words.count_without(words.title_words(lines, text_functions.DEFAULT_DELIMITERS), inputs.stop_words(t))


@query
def title_word_count(t: Tables) -> DataFrame:
    return _title_counts(t)


@query
def top_titles(t: Tables) -> DataFrame:
    return words.top_words(_title_counts(t))


@query
def top_title_stats(t: Tables) -> DataFrame:
    return words.count_statistics(words.top_words(_title_counts(t)))


@query
def top_title_stats_exact(t: Tables) -> DataFrame:
    return words.count_statistics(words.top_words(_title_counts(t)), exact=True)


@query
def topn_report(t: Tables) -> DataFrame:
    spoken = words.normalized_words(words.sentence_words(inputs.document_lines(t.documents)))
    return words.top_words_report(words.word_count(spoken))


# --- links and graphs -------------------------------------------------------------------------------------------------

@query
def graph_parse_adjacency(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "adjacency")
    inputs.adjacency_lines(t).write.text(path)
    edges = text_files.read_adjacency(t.spark, path)
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


@query
def graph_vertices(t: Tables) -> DataFrame:
    return lk.vertices(inputs.links(t))


@query
def inlink_count(t: Tables) -> DataFrame:
    return lk.inlink_count(inputs.links(t))


@query
def orphan_pages(t: Tables) -> DataFrame:
    return lk.orphan_pages(inputs.links(t))


@query
def top_popular_links(t: Tables) -> DataFrame:
    return lk.top_popular_links(inputs.links(t))


@query
def popularity_league(t: Tables) -> DataFrame:
    return lk.popularity_league(inputs.links(t), inputs.league(t))


@query
def rank_line_prices(t: Tables) -> DataFrame:
    """For each order line, the number of lines with a lower price."""
    return rank_below(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"), "l_extendedprice")


@query
def graph_components(t: Tables) -> DataFrame:
    edges = inputs.territory_edges(t)
    return graph.connected_components(lk.vertices(edges), edges)


@query
def graph_sssp(t: Tables) -> DataFrame:
    edges = inputs.part_tree(t)
    return graph.shortest_paths(lk.vertices(edges), edges, SOURCE_VERTEX)


# --- recommendation and learning --------------------------------------------------------------------------------------

@query
def distinct_users(t: Tables) -> DataFrame:
    return recommend.distinct_users(inputs.raw_ratings(t)).agg(F.count(F.lit(1)).alias("users"))


@query
def user_index(t: Tables) -> DataFrame:
    return recommend.user_index(inputs.raw_ratings(t))


@query
def rating_movie_join(t: Tables) -> DataFrame:
    joined = recommend.rating_movie_join(inputs.ratings(t), inputs.movies(t))
    return joined.select("user_id", "movie_id", "rating", "title", "genres")


@query
def movie_rating_vectors(t: Tables) -> DataFrame:
    vectors = recommend.movie_rating_vectors(durable(inputs.ratings(t)), inputs.movies(t), block=512)
    pair = lambda e: F.concat_ws(":", e["user_index"].cast("string"), e["rating"].cast("string"))
    return vectors.select(
        "movie_id", "block", F.array_join(F.transform("user_rates", pair), " ").alias("user_rates"), "title", "genres")


@query
def movie_lookup(t: Tables) -> DataFrame:
    return recommend.movie_lookup(inputs.movies(t), "gizmo")


@query
def movie_similarity(t: Tables) -> DataFrame:
    return recommend.movie_similarity(inputs.ratings(t), inputs.movies(t), SOURCE_MOVIE)


@query
def movie_similarity_topk(t: Tables) -> DataFrame:
    return similar.similar_movies(inputs.ratings(t), k=5)


FEATURES = ["size", "price", "quantity", "discount"]


def _members(t: Tables) -> DataFrame:
    points = durable(learn.assemble(inputs.part_features(t), FEATURES))
    return learn.kmeans_members(learn.fit_kmeans(points), points)


@query
def kmeans_clusters(t: Tables) -> DataFrame:
    return learn.kmeans_sizes(_members(t))


@query
def kmeans_members(t: Tables) -> DataFrame:
    return _members(t)


@query
def random_forest_predict(t: Tables) -> DataFrame:
    points = durable(learn.assemble(inputs.part_features(t), FEATURES))
    return learn.classify(learn.fit_forest(points), points, "part", *FEATURES)


@query
def random_forest_files(t: Tables) -> DataFrame:
    """Even parts by a forest grown on odd ones, both out of point files, as written to result files."""
    root = scratch_path(t.spark, "forest")
    points = inputs.part_features(t).select(*FEATURES, "label", (F.col("part") % 2).alias("fold"))
    points.write.partitionBy("fold").csv(root)
    train, test = (
        learn.assemble(text_files.read_labeled_points(t.spark, f"{root}/fold={fold}", len(FEATURES)), ["x1", "x2", "x3", "x4"])
        for fold in (1, 0))
    results = f"{root}/results"
    sink.write_results(learn.classify(learn.fit_forest(durable(train)), test, "label", "x1", "x2", "x3", "x4"), results)
    return t.spark.read.parquet(results)


# --- SQL functions ----------------------------------------------------------------------------------------------------

@query
def sql_tokenize_sentence(t: Tables) -> DataFrame:
    register_functions(t.spark)
    return t.spark.sql(
        "SELECT doc_id, array_join(tokenize_sentence(text), ' ') AS words FROM {documents}", documents=t.documents)


@query
def sql_ring_position(t: Tables) -> DataFrame:
    register_functions(t.spark)
    return t.spark.sql(
        "SELECT key, ring_position(CAST(key AS STRING)) AS pos FROM {keys}", keys=inputs.ring_keys(t))


@query
def sql_similarity(t: Tables) -> DataFrame:
    """Similarity of each movie with one movie, within every block of users that rated both."""
    register_functions(t.spark)
    vectors = recommend.movie_rating_vectors(durable(inputs.ratings(t)), inputs.movies(t), block=512)
    return t.spark.sql(
        "SELECT v.movie_id, v.block, round(calculate_similarity(s.user_rates, v.user_rates), 9) AS score "
        "FROM {vectors} v JOIN {source} s ON v.block = s.block",
        vectors=vectors, source=vectors.where(F.col("movie_id") == SOURCE_MOVIE))


# --- streams ----------------------------------------------------------------------------------------------------------

def _flight_stream(t: Tables, fields: list[str]) -> DataFrame:
    return inputs.flights(t, fields, t.stream("lineitem"))


@query
def stream_top_airports(t: Tables) -> DataFrame:
    return jobs.stream_top_airports(_flight_stream(t, ["origin", "dest"]))


@query
def stream_ontime_weekday(t: Tables) -> DataFrame:
    return jobs.stream_on_time_weekday(_flight_stream(t, ["day_of_week", "arr_delayed"]))


@query
def stream_top_airlines_from_x(t: Tables) -> DataFrame:
    flights = _flight_stream(t, ["origin", "airline_id", "dep_delayed"])
    return jobs.stream_top_airlines_from(flights, inputs.airport_list(t))


@query
def stream_top_airlines_xy(t: Tables) -> DataFrame:
    return jobs.stream_top_airlines_between(_flight_stream(t, AIRLINE_FIELDS), inputs.pair_list(t))


@query
def stream_mean_delay(t: Tables) -> DataFrame:
    return jobs.stream_mean_delay(_flight_stream(t, ["origin", "dest", "arr_delay_minutes"]), inputs.pair_list(t))


@query
def stream_trip_best(t: Tables) -> DataFrame:
    return jobs.stream_best_trips(_flight_stream(t, TRIP_FIELDS), inputs.trip_requests(t))


@query
def stream_sensor_alarms(t: Tables) -> DataFrame:
    return jobs.stream_sensor_alarms(inputs.sensor_lines(t.stream("events")))


@query
def stream_word_count(t: Tables) -> DataFrame:
    return jobs.stream_word_count(inputs.document_lines(t.stream("documents")))


@query
def stream_word_count_normalized(t: Tables) -> DataFrame:
    return jobs.stream_word_count_normalized(inputs.document_lines(t.stream("documents")))


@query
def stream_top_words(t: Tables) -> DataFrame:
    return jobs.stream_top_words(inputs.document_lines(t.stream("documents")))


@query
def stream_heartbeat_status(t: Tables) -> DataFrame:
    now = inputs.heartbeats(t.events).agg(F.max("tick")).first()[0]
    return jobs.stream_heartbeat_status(inputs.heartbeats(t.stream("events")), now)


def _in_batches(t: Tables, df: DataFrame, batches: int = 5) -> DataFrame:
    """The rows of ``df`` as a stream of so many micro-batches, each of a file for every core."""
    path = scratch_path(t.spark, "files")
    files = t.spark.sparkContext.defaultParallelism
    df.repartition(batches * files).write.parquet(path)
    return stream_source(t.spark, "parquet", path, df.schema, max_files_per_trigger=files)


@query
def stream_mean_delay_batches(t: Tables) -> DataFrame:
    flights = inputs.flights(t, ["origin", "dest", "arr_delay_minutes"])
    return jobs.stream_mean_delay(_in_batches(t, flights), inputs.pair_list(t))


@query
def stream_word_count_batches(t: Tables) -> DataFrame:
    return jobs.stream_word_count(_in_batches(t, inputs.document_lines(t.documents)))


@query
def stream_failure_transitions(t: Tables) -> DataFrame:
    return live.stream_failure_transitions(inputs.heartbeats(t.stream("events")), DETECTION_LAG)


def _log_stream(t: Tables) -> DataFrame:
    return inputs.change_log(t, t.stream("events"))


@query
def stream_batch_counts(t: Tables) -> DataFrame:
    """Records of each micro-batch of the event stream, as the query's listener was told."""
    table = RunningTable(scratch_path(t.spark, "events"), [], t.events.schema)
    return run_logged(t.stream("events"), table.write_batch, scratch_path(t.spark, "checkpoint"), "append")


@query
def stream_changelog_audit(t: Tables) -> DataFrame:
    return live.stream_changelog_audit(_log_stream(t), AUDIT_LAG)


@query
def stream_changelog_state(t: Tables) -> DataFrame:
    return live.stream_changelog_state(_log_stream(t), AUDIT_LAG)


# --- event logs -------------------------------------------------------------------------------------------------------

@query
def sensor_alarms(t: Tables) -> DataFrame:
    return sensors.alarms(sensors.parse_messages(inputs.sensor_lines(t.events)))


@query
def changelog_state(t: Tables) -> DataFrame:
    return changelog.changelog_state(inputs.change_log(t))


@query
def changelog_audit(t: Tables) -> DataFrame:
    return changelog.changelog_audit(inputs.change_log(t))


@query
def changelog_audit_counts(t: Tables) -> DataFrame:
    return changelog.audit_counts(changelog.changelog_audit(inputs.change_log(t)))


@query
def quorum_read(t: Tables) -> DataFrame:
    return replicas.quorum_read(inputs.replicas(t), replica="r")


@query
def quorum_write(t: Tables) -> DataFrame:
    return replicas.quorum_write(
        inputs.replicas(t).select("key", "r", F.col("value").isNotNull().alias("ok")), replica="r")


@query
def ring_placement(t: Tables) -> DataFrame:
    return replicas.ring_placement(inputs.ring_keys(t), inputs.ring_nodes(t))


@query
def ring_balance(t: Tables) -> DataFrame:
    return replicas.ring_balance(inputs.ring_keys(t), inputs.ring_nodes(t))


@query
def heartbeat_status(t: Tables) -> DataFrame:
    beats = inputs.heartbeats(t.events)
    return membership.heartbeat_status(membership.last_advance(beats), beats.agg(F.max("tick")).scalar())


@query
def membership_audit(t: Tables) -> DataFrame:
    return membership.membership_audit(membership.parse_membership_log(inputs.membership_lines(t)))
