"""The most similar movies of every movie against all pairs."""

import glob
import math
import random
import time
from collections import defaultdict

import pytest

from skytally.operators import similar
from skytally.operators.similar import candidate_pairs, similar_movies
from skytally.plans.durable import FREE, stored
from skytally.plans.inspect import plan_text
from tests.conftest import rows


def plain(ratings, k):
    of = defaultdict(dict)
    for user, movie, rating in ratings:
        if rating is not None and rating > 0:
            of[movie][user] = rating
    norm = {m: math.sqrt(sum(r * r for r in v.values())) for m, v in of.items()}
    out = []
    for m, v in of.items():
        scores = []
        for o, w in of.items():
            if o != m and v.keys() & w.keys():
                scores.append((-round(sum(r * w[u] for u, r in v.items() if u in w) / (norm[m] * norm[o]), 9), o))
        out += [(m, i + 1, o, -s) for i, (s, o) in enumerate(sorted(scores)[:k])]
    return out


def close(found, expected):
    assert [r[:3] for r in sorted(found)] == [r[:3] for r in sorted(expected)]
    assert all(abs(a[3] - b[3]) < 2e-9 for a, b in zip(sorted(found), sorted(expected)))


@pytest.mark.parametrize("k, light, chunk", [(3, 64, 4096), (2, 20, 7), (5, 6, 3)])
def test_equals_all_pairs(spark, monkeypatch, k, light, chunk):
    monkeypatch.setattr(similar, "ROWS_PER_CHUNK", chunk)
    r = random.Random(k * 10 + light)
    ratings = [(u, m, r.randint(1, 5)) for u in range(60) for m in r.sample(range(80), r.choice([1, 2, 3, 4, 12, 18, 30, 50]))]
    ratings += [(100, m, 5) for m in range(200)] + [(101, 500, 2), (101, 501, 1), (102, 700, 3), (103, 1, 0), (104, 2, None)]
    table = spark.createDataFrame(ratings, "user_id INT, movie_id INT, rating INT")
    close(rows(similar_movies(table, k, light=light)), plain(ratings, k))


def test_empty_table(spark):
    assert similar_movies(spark.createDataFrame([], "user_id INT, movie_id INT, rating INT")).count() == 0


def test_a_heavy_rater_does_not_pair_all_its_movies(spark):
    """Clusters of movies that a few users know, and one user who rated all of them."""
    r = random.Random(9)
    counts = {}
    for clusters in (20, 40):
        ratings = [(1000 * c + u, 10 * c + m, r.randint(3, 5)) for c in range(clusters) for u in range(12) for m in range(10)]
        ratings += [(-1, m, 1) for m in range(10 * clusters)]
        table = spark.createDataFrame(ratings, "user_id INT, movie_id INT, rating INT")
        pairs, _, facts = candidate_pairs(table, 5, light=20)
        counts[clusters] = pairs.count()
        assert facts.where("cut >= 8").count() == 0  # nobody looks through the heavy rater
        close(rows(similar_movies(table, 5, light=20)), plain(ratings, 5))
    assert counts[40] <= 2 * counts[20] <= 2 * 20 * 10 * 9  # of 400 * 399 pairs
    plan = plan_text(similar_movies(table, 5, light=20))
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


@pytest.mark.parametrize("block, at_once, light", [(4_000_000, 1_000_000, 64), (900, 50, 64), (300, 10, 20)])
def test_blocks_of_movies_keep_only_their_best_pairs(spark, monkeypatch, block, at_once, light):
    """Many pairs share a rater; what blocks hand on grows with the movies. Some movies are too popular for a block."""
    monkeypatch.setattr(similar, "PER_BLOCK", block)
    monkeypatch.setattr(similar, "AT_ONCE", at_once)
    r = random.Random(block)
    ratings = [(u, 7 * m - 500, r.randint(1, 5)) for u in range(150) for m in {*r.sample(range(200), r.choice([2, 9, 30])), u % 2}]
    table = spark.createDataFrame(ratings, "user_id INT, movie_id BIGINT, rating INT")
    close(rows(similar_movies(table, 4, light=light)), plain(ratings, 4))
    if block > 1000:
        weighted, _ = similar._weighted(table)
        near = similar._near(weighted, weighted.where("false"), 4).count()
        shared = similar._pair_sums(weighted, weighted, ["user_id"]).count()
        assert near <= 200 * 8 < shared / 5


def exchanged(spark):
    """The files of all exchanges that lie on this session's disks."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_what_was_exchanged_is_removed_with_each_step(spark, monkeypatch):
    r = random.Random(3)
    ratings = [(u, m, r.randint(1, 5)) for u in range(80) for m in r.sample(range(60), r.choice([2, 9, 30]))]
    table = spark.createDataFrame(ratings, "user_id INT, movie_id INT, rating INT").repartition(4)
    setting = spark.conf.get(FREE, None)
    before = exchanged(spark)
    assert stored(table.groupBy("movie_id").count(), free=True).inputFiles()
    until = time.time() + 20  # executors remove them when they are told to
    while exchanged(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not exchanged(spark) - before
    assert spark.conf.get(FREE, None) == setting
    steps = []
    monkeypatch.setattr(similar, "stored", lambda df, free=False: steps.append(free) or stored(df, free))
    close(rows(similar_movies(table, 3, light=64)), plain(ratings, 3))
    assert steps and all(steps)


def test_vectors_go_to_their_blocks_in_rounds(spark, monkeypatch):
    """What is on its way to blocks is bounded by the vectors, however many blocks a vector goes to."""
    monkeypatch.setattr(similar, "PER_BLOCK", 2000)
    monkeypatch.setattr(similar, "LEAST_ROUND", 1)
    monkeypatch.setattr(similar, "ROUND", 2)
    routes, route = [], similar._route
    monkeypatch.setattr(similar, "_route", lambda *given: routes.append(given) or route(*given))
    r = random.Random(8)
    ratings = [(u, 3 * m, r.randint(1, 5)) for u in range(120) for m in r.sample(range(150), 20)]
    table = spark.createDataFrame(ratings, "user_id INT, movie_id INT, rating INT")
    found = rows(similar_movies(table, 3, light=64))
    assert len(routes) > 3
    assert [low for _, _, low, _ in routes] == [0] + [high for _, _, _, high in routes[:-1]]
    lows, blocks = routes[0][0], defaultdict(set)
    assert routes[-1][3] == len(lows)
    for user, movie, _ in ratings:
        blocks[user].add(sum(low <= movie for low in lows) - 1)
    for _, _, low, high in routes:
        sent = sum(20 for b in blocks.values() for i in b if low <= i < high)
        assert sent <= 2 * len(ratings) + len(ratings)  # the last block may begin within the bound
    assert sum(20 * len(b) for b in blocks.values()) > 6 * len(ratings)
    close(found, plain(ratings, 3))


def test_heavy_raters_beside_light_ones_in_many_batches(spark):
    """A block gets the light users' vectors in many rows, each with what heavy users may add to its movies."""
    r = random.Random(21)
    ratings = [(u, m, r.randint(1, 5)) for u in range(90) for m in r.sample(range(70), r.choice([2, 3, 8]))]
    ratings += [(-u, m, r.randint(1, 300)) for u in (1, 2) for m in range(0, 70, u)]
    table = spark.createDataFrame(ratings, "user_id INT, movie_id INT, rating INT")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        close(rows(similar_movies(table, 4, light=10)), plain(ratings, 4))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
