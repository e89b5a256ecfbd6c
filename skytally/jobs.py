"""Whole jobs from files to files, as run by ``spark-submit`` or ``python -m skytally``.

Flight inputs are manifests (one path per line), streams are folders of text files or Kafka topics.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skytally.functions.text import DEFAULT_DELIMITERS
from skytally.operators import flights as fl, graph, learn, links, recommend, sensors, trips, words
from skytally.sinks import tables as sink
from skytally.sources import flights as flight_files, params, text
from skytally.sources.streams import stream_source
from skytally.streaming import jobs as streams

Job = Callable[[SparkSession, argparse.Namespace], DataFrame]

JOBS: dict[str, tuple[Job, list[str]]] = {}


def job(*arguments: str) -> Callable[[Job], Job]:
    """Register a job under its name, with its positional arguments; the last argument of each is ``output``."""
    def register(run: Job) -> Job:
        JOBS[run.__name__.replace("_", "-")] = (run, list(arguments))
        return run
    return register


def _flights(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return flight_files.read_flights_from_manifest(spark, args.manifest)


def _flight_stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return flight_files.parse_flight_lines(_line_stream(spark, args))


def _line_stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.servers:
        return stream_source(
            spark, "kafka", servers=args.servers, topic=args.source, from_start=args.from_start,
            max_records_per_trigger=args.rate)
    return stream_source(spark, "text", args.source, max_files_per_trigger=args.rate)


# --- flights ----------------------------------------------------------------------------------------------------------

@job("source")
def clean(spark, args):
    """Project on-time performance files to the cleaned flight columns."""
    return flight_files.read_on_time_files(spark, args.source)


@job("manifest")
def top_airports(spark, args):
    return fl.top_airports(_flights(spark, args), args.n)


@job("manifest")
def rank_airports(spark, args):
    return fl.rank_airports(_flights(spark, args))


@job("manifest")
def zipf(spark, args):
    return fl.zipf_compare(fl.airport_popularity(_flights(spark, args)))


@job("manifest")
def rank_weekdays(spark, args):
    return fl.rank_weekdays(_flights(spark, args))


@job("manifest", "origins")
def airlines_from(spark, args):
    origins = params.read_key_list(spark, args.origins)
    return fl.top_airlines_from(fl.on_time_by_origin_airline(_flights(spark, args), origins), args.n)


@job("manifest", "pairs")
def airlines_between(spark, args):
    pairs = params.read_pair_list(spark, args.pairs)
    return fl.top_airlines_between(fl.on_time_by_pair_airline(_flights(spark, args), pairs), args.n)


@job("manifest", "pairs")
def mean_delay(spark, args):
    return fl.mean_delay(_flights(spark, args), params.read_pair_list(spark, args.pairs))


@job("manifest", "requests")
def best_trips(spark, args):
    return trips.find_trips(_flights(spark, args), params.read_trip_requests(spark, args.requests))


# --- text and links ---------------------------------------------------------------------------------------------------

def _title_counts(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    stops = params.read_key_list(spark, args.stop_words, "word")
    return words.count_without(words.title_words(text.read_lines(spark, args.titles), args.delimiters), stops)


@job("titles", "stop_words")
def title_count(spark, args):
    return _title_counts(spark, args)


@job("titles", "stop_words")
def top_titles(spark, args):
    return words.top_words(_title_counts(spark, args), args.n)


@job("titles", "stop_words")
def title_statistics(spark, args):
    return words.count_statistics(words.top_words(_title_counts(spark, args), args.n))


def _links(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return text.read_adjacency(spark, args.links).select("src", "dst")


@job("links")
def orphan_pages(spark, args):
    return links.orphan_pages(_links(spark, args))


@job("links")
def popular_links(spark, args):
    return links.top_popular_links(_links(spark, args), args.n)


@job("links", "league")
def popularity_league(spark, args):
    league = params.read_key_list(spark, args.league, "id").select(F.col("id").cast("bigint").alias("id"))
    return links.popularity_league(_links(spark, args), league)


@job("links")
def components(spark, args):
    edges = _links(spark, args)
    return graph.connected_components(links.vertices(edges), edges)


@job("links", "vertex")
def shortest_paths(spark, args):
    edges = _links(spark, args)
    return graph.shortest_paths(links.vertices(edges), edges, int(args.vertex), integer_unreachable=True)


# --- recommendation and learning --------------------------------------------------------------------------------------

@job("ratings", "movies", "title")
def similar_movies(spark, args):
    """All movies by similarity to the first one whose title contains the given text."""
    movies = text.read_movies(spark, args.movies)
    source = recommend.movie_lookup(movies, args.title).first()
    if source is None:
        raise SystemExit(f"no title contains {args.title!r}")
    ratings = recommend.latest_ratings(text.read_ratings(spark, args.ratings), "rated_at", "rating")
    return recommend.movie_similarity(ratings, movies, source.movie_id)


def _names(args: argparse.Namespace) -> list[str]:
    return [f"x{i}" for i in range(1, int(args.features) + 1)]


@job("points", "features")
def kmeans(spark, args):
    points = learn.assemble(text.read_titled_points(spark, args.points, int(args.features)), _names(args))
    return learn.kmeans_members(learn.fit_kmeans(points), points)


@job("training", "points", "features")
def random_forest(spark, args):
    read = lambda path: learn.assemble(text.read_labeled_points(spark, path, int(args.features)), _names(args))
    return learn.classify(learn.fit_forest(read(args.training)), read(args.points), *_names(args))


# --- tables and messages ----------------------------------------------------------------------------------------------

@job("columns", "rows")
def load_table(spark, args):
    """Result lines as an all-text table; the last row of a key (the first column) stays."""
    columns = sink.read_column_list(spark, args.columns)
    return sink.load_last_rows(spark, args.rows, columns)


@job("manifest")
def publish(spark, args):
    """Send the lines of the listed files to the topic ``output`` (with ``--servers``) or to a folder."""
    lines = text.read_lines(spark, flight_files.read_manifest(spark, args.manifest))
    if args.servers:
        sink.publish(lines, args.output, "kafka", **{"kafka.bootstrap.servers": args.servers})
        return None
    return sink.non_blank_lines(lines)


# --- streams: all input there is, continuing after the last run when --root is given again -----------------------------

@job("source")
def stream_top_airports(spark, args):
    return streams.stream_top_airports(_flight_stream(spark, args), args.n, args.root)


@job("source")
def stream_rank_weekdays(spark, args):
    return streams.stream_on_time_weekday(_flight_stream(spark, args), args.root)


@job("source", "origins")
def stream_airlines_from(spark, args):
    origins = params.read_key_list(spark, args.origins)
    return streams.stream_top_airlines_from(_flight_stream(spark, args), origins, args.n, args.root)


@job("source", "pairs")
def stream_airlines_between(spark, args):
    pairs = params.read_pair_list(spark, args.pairs)
    return streams.stream_top_airlines_between(_flight_stream(spark, args), pairs, args.n, args.root)


@job("source", "pairs")
def stream_mean_delay(spark, args):
    return streams.stream_mean_delay(_flight_stream(spark, args), params.read_pair_list(spark, args.pairs), args.root)


@job("source", "requests")
def stream_best_trips(spark, args):
    requests = params.read_trip_requests(spark, args.requests)
    return streams.stream_best_trips(_flight_stream(spark, args), requests, root=args.root)


@job("source")
def stream_alarms(spark, args):
    low = sensors.MIN_VALUE if args.min_value is None else args.min_value
    high = sensors.MAX_VALUE if args.max_value is None else args.max_value
    return streams.stream_sensor_alarms(_line_stream(spark, args), low, high, args.root)


@job("source")
def stream_word_count(spark, args):
    return streams.stream_word_count(_line_stream(spark, args), args.root)


@job("source")
def stream_normalized_word_count(spark, args):
    return streams.stream_word_count_normalized(_line_stream(spark, args), args.root)


@job("source")
def stream_top_words(spark, args):
    return streams.stream_top_words(_line_stream(spark, args), args.n, args.root)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skytally", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="job", required=True)
    for name, (run, arguments) in JOBS.items():
        command = commands.add_parser(name, help=(run.__doc__ or name.replace("-", " ")).strip())
        for argument in [*arguments, "output"]:
            command.add_argument(argument)
        command.add_argument("--format", default="parquet", help="tsv, or a format Spark writes")
        command.add_argument("-n", type=int, default=10, help="rows of a top list")
        command.add_argument("--delimiters", default=DEFAULT_DELIMITERS)
        command.add_argument("--servers", help="Kafka servers; source or output is then a topic")
        command.add_argument("--from-start", action="store_true", help="read the topic from its beginning")
        command.add_argument("--rate", type=int, help="records or files per micro-batch")
        command.add_argument("--root", help="folder of a stream's checkpoint and tables")
        command.add_argument("--min-value", type=int)
        command.add_argument("--max-value", type=int)
    return top


def run(spark: SparkSession, argv: list[str]) -> None:
    """Run one job and write its result."""
    args = parser().parse_args(argv)
    result = JOBS[args.job][0](spark, args)
    if result is None:
        return
    if args.format == "tsv":
        sink.write_tsv(result, args.output)
    else:
        sink.write_results(result, args.output, args.format)
