"""Item-to-item recommendation from ratings (user_id, movie_id, rating, ...)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from skytally.plans.durable import durable
from skytally.plans.joins import BROADCAST_ROWS, fits_broadcast, lookup_join
from skytally.plans.ranking import top_k, with_position

BLOCK = 4096  # users per block of a rating vector


def latest_ratings(ratings: DataFrame, *sequence: str) -> DataFrame:
    """One rating per user and movie: the last in ``sequence`` order."""
    newest = F.max_by("rating", F.struct(*sequence)).alias("rating")
    return ratings.groupBy("user_id", "movie_id").agg(newest)


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_id").distinct()


def user_index(ratings: DataFrame) -> DataFrame:
    """Users numbered 0, 1, ... by id, without collecting them."""
    return with_position(distinct_users(ratings), F.asc("user_id"), name="user_index")


def rating_movie_join(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings with title and genres."""
    if fits_broadcast(movies):
        return ratings.join(F.broadcast(movies), "movie_id")
    return lookup_join(ratings, movies, "movie_id")


def movie_rating_vectors(ratings: DataFrame, movies: DataFrame, block: int = BLOCK) -> DataFrame:
    """Sparse rating vectors, cut into blocks of ``block`` user indexes.

    Row: movie_id, block number, sorted array of (user_index, rating), title, genres. A movie that a third of all
    users rated is many rows of bounded size instead of one array that no task could hold.
    """
    index = user_index(ratings)
    if fits_broadcast(index):
        indexed = ratings.join(F.broadcast(index), "user_id")
    else:
        indexed = lookup_join(ratings, index, "user_id")
    entry = F.struct("user_index", "rating")
    vectors = indexed.groupBy("movie_id", F.floor(F.col("user_index") / block).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("user_rates")
    )
    return rating_movie_join(vectors, movies)


def movie_lookup(movies: DataFrame, text: str) -> DataFrame:
    """The first movie (smallest id) whose title contains ``text``."""
    return top_k(movies.where(F.contains("title", F.lit(text))), 1, F.asc("movie_id"))


def movie_similarity(ratings: DataFrame, movies: DataFrame, source_movie_id: int, digits: int = 9) -> DataFrame:
    """Cosine similarity of every rated movie to one movie, highest first.

    ``ratings`` has one row per user and movie. Unrated counts as 0, so the dot product runs over common users and
    the norms over all ratings of a movie: one left join and one aggregation give both, movies without a common user
    keep score 0, and no vector is built. The ratings of the one movie are found first, and their number decides how
    they are joined.
    """
    source = durable(ratings.where(F.col("movie_id") == source_movie_id).select(
        "user_id", F.col("rating").cast("bigint").alias("source_rating")))
    raters, source_squares = source.agg(
        F.count(F.lit(1)), F.sum(F.col("source_rating") * F.col("source_rating"))).first()
    own = F.col("rating").cast("bigint")
    if raters <= BROADCAST_ROWS:
        paired = ratings.join(F.broadcast(source), "user_id", "left")
    else:
        paired = lookup_join(ratings, source, "user_id", how="left")
    sums = paired.groupBy("movie_id").agg(
        F.sum(own * F.coalesce("source_rating", F.lit(0))).alias("dot"), F.sum(own * own).alias("squares")
    )
    norms = F.sqrt("squares") * math.sqrt(source_squares or 0)
    scores = sums.where(F.lit(raters > 0)).select(
        "movie_id", F.round(F.try_divide(F.col("dot"), norms), digits).alias("score"))
    return scores.join(movies, "movie_id").orderBy(F.desc("score"), F.asc("movie_id"))
