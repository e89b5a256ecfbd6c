import math

import pytest

from skytally.operators import learn, recommend
from skytally.plans.inspect import plan_text
from tests.conftest import rows

RATINGS = [(1, 10, 4), (2, 10, 3), (1, 20, 2), (3, 20, 5), (4, 30, 1), (1, 40, 4), (2, 40, 3)]
MOVIES = [(10, "Star One", "a"), (20, "Two", "b"), (30, "Lone Star", "c"), (40, "Twin", "d"), (50, "Unrated", "e")]


@pytest.fixture
def ratings(spark):
    return spark.createDataFrame(RATINGS, "user_id BIGINT, movie_id BIGINT, rating INT")


@pytest.fixture
def movies(spark):
    return spark.createDataFrame(MOVIES, "movie_id BIGINT, title STRING, genres STRING")


@pytest.mark.parametrize("broadcast", [True, False])
def test_similarity(ratings, movies, monkeypatch, broadcast):
    monkeypatch.setattr("skytally.operators.recommend.BROADCAST_ROWS", 100 if broadcast else 0)
    found = recommend.movie_similarity(ratings, movies, 10)
    scores = [(r.movie_id, r.score) for r in found.collect()]
    two = round(8 / (5 * math.sqrt(29)), 9)
    assert scores == [(10, 1.0), (40, 1.0), (20, two), (30, 0.0)]  # the unrated movie has no vector
    plan = plan_text(found)
    assert not any(step in plan for step in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_similarity_to_an_unrated_movie_is_empty(ratings, movies):
    assert recommend.movie_similarity(ratings, movies, 50).count() == 0


def test_the_last_rating_counts(spark):
    raw = spark.createDataFrame([(1, 10, 4, 5), (1, 10, 2, 9), (1, 20, 3, 1)], "user_id INT, movie_id INT, rating INT, ts INT")
    assert rows(recommend.latest_ratings(raw, "ts").select("user_id", "movie_id", "rating")) == [(1, 10, 2), (1, 20, 3)]


def test_users_and_vectors(ratings, movies):
    assert recommend.distinct_users(ratings).count() == 4
    assert rows(recommend.user_index(ratings)) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    vectors = recommend.movie_rating_vectors(ratings, movies, block=2)
    found = [(r.movie_id, r.block, [tuple(p) for p in r.user_rates], r.title) for r in vectors.collect()]
    assert sorted(found) == [
        (10, 0, [(0, 4), (1, 3)], "Star One"), (20, 0, [(0, 2)], "Two"), (20, 1, [(2, 5)], "Two"),
        (30, 1, [(3, 1)], "Lone Star"), (40, 0, [(0, 4), (1, 3)], "Twin")]


def test_lookup(movies):
    assert rows(recommend.movie_lookup(movies, "Star").select("movie_id")) == [(10,)]
    assert recommend.movie_lookup(movies, "none").count() == 0


def test_kmeans(spark):
    data = [(f"p{i}", float(i // 10 * 100 + i % 3), 1.0) for i in range(40)]
    points = learn.assemble(spark.createDataFrame(data + [("gap", None, 1.0)], "title STRING, x1 DOUBLE, x2 DOUBLE"), ["x1", "x2"])
    members = learn.kmeans_members(learn.fit_kmeans(points), points)
    assert members.count() == 40 and members.select("cluster").distinct().count() <= 4
    assert learn.kmeans_sizes(members).agg({"size": "sum"}).first()[0] == 40


def test_forest(spark):
    data = [(float(i), float(i % 7), float(i > 50)) for i in range(100)]
    points = learn.assemble(spark.createDataFrame(data, "x1 DOUBLE, x2 DOUBLE, label DOUBLE"), ["x1", "x2"])
    model = learn.fit_forest(points)
    assert model.getNumTrees == 3
    predicted = learn.classify(model, points, "x1", "label").collect()
    assert {r.prediction for r in predicted} <= {0.0, 1.0}
    assert sum(r.prediction == r.label for r in predicted) > 90
