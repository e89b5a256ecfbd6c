import bisect
import random

from pyspark.sql import functions as F

from skytally.plans.durable import checkpoint_root, durable, scratch_path
from skytally.plans.inspect import plan_text
from skytally.plans.joins import ROWS_PER_TASK, fits_broadcast, lookup_join, restrict_to
from skytally.plans.ranking import count_below, rank_below, top_k, with_position
from skytally.session import shuffle_conf
from tests.conftest import rows


def test_positions_are_whole_over_many_partitions(spark):
    values = [random.Random(4).randrange(50) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(values)), "k INT, v INT").repartition(16)
    found = with_position(df, F.desc("v"), F.asc("k"))
    expected = sorted(enumerate(values), key=lambda e: (-e[1], e[0]))
    assert [(r.k, r.v) for r in sorted(found.collect(), key=lambda r: r.id)] == expected
    assert rows(found.agg(F.min("id"), F.max("id"), F.count_distinct("id"))) == [(0, 4999, 5000)]


def test_shuffle_partitions_follow_data_and_cores():
    assert shuffle_conf(10 * 2**40, 4000)["spark.sql.shuffle.partitions"] == "81920"
    assert shuffle_conf(0, 8)["spark.sql.shuffle.partitions"] == "16"


def test_positions_of_nothing(spark):
    assert with_position(spark.createDataFrame([], "v INT"), F.asc("v")).collect() == []


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), F.lit(1).alias("n"))
    results = []
    for partitions in ("3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        counts = df.groupBy("k").agg(F.sum("n").alias("n"))
        results.append((rows(with_position(counts, F.desc("n"), F.desc("k"))),
                        rows(top_k(counts, 5, F.desc("n"), F.desc("k")), "kept")))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_count_below_shares_ties(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 5), ("d", 7), ("e", 7)], "id STRING, n BIGINT")
    assert rows(count_below(df, "n").select("id", "rank")) == [("a", 0), ("b", 0), ("c", 2), ("d", 3), ("e", 3)]


def test_lookup_join_gives_the_same_rows_with_and_without_hot_keys(spark):
    # key 0 holds a third of the rows; keys 90.. have no lookup row
    left = spark.createDataFrame([(0 if i % 3 == 0 else i % 100, i) for i in range(900)], "k INT, i INT")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(90)], "k INT, v STRING")
    for how in ("inner", "left"):
        plain = rows(lookup_join(left, lookup, "k", 900, how))
        assert rows(lookup_join(left, lookup, "k", 900, how, rows_per_task=50)) == plain
        assert rows(lookup_join(left, lookup, "k", None, how, rows_per_task=50)) == plain
        assert rows(left.join(lookup, "k", how)) == plain


def test_restrict_to_checks_the_size_of_the_list(spark, monkeypatch):
    df = spark.range(100).withColumnRenamed("id", "k")
    wanted = spark.createDataFrame([(3,), (5,), (5,), (1000,)], "k BIGINT")
    assert fits_broadcast(wanted, 4) and not fits_broadcast(wanted, 3)
    assert rows(restrict_to(df, wanted, ["k"])) == [(3,), (5,)]
    assert restrict_to(df, wanted, ["k"], anti=True).count() == 98
    monkeypatch.setattr("skytally.plans.joins.fits_broadcast", lambda df: False)
    assert rows(restrict_to(df, wanted, ["k"])) == [(3,), (5,)]


def test_checkpoint_folder_is_the_one_the_session_names(spark):
    root = checkpoint_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named
    assert scratch_path(spark, "x").startswith(root.rstrip("/")) and scratch_path(spark, "x") != scratch_path(spark, "x")
    assert "LogicalRDD" in durable(spark.range(3))._jdf.queryExecution().toString()


def test_ranks_of_any_measure_share_ties_across_partitions(spark):
    rng = random.Random(5)
    values = [rng.choice([2.5, 2.5, 2.5, rng.random() * 5, -1e300, None, float("nan")]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "k INT, v DOUBLE").repartition(16)
    order = lambda v: (v != v, v if v == v else 0)
    known = sorted((order(v) for v in values if v is not None))
    expected = {k: None if v is None else bisect.bisect_left(known, order(v)) for k, v in enumerate(values)}
    for rows_per_task in (ROWS_PER_TASK, 100):
        found = rank_below(df, "v", rows_per_task=rows_per_task)
        assert found.columns == ["k", "v", "rank"]
        assert {r.k: r["rank"] for r in found.collect()} == expected and found.count() == 3000
    words = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "w STRING")
    assert rows(rank_below(words, "w")) == [("a", 0), ("b", 1), ("b", 1), ("c", 3)]
    assert rows(rank_below(words.where("false"), "w")) == []


def test_no_rank_needs_all_rows_in_one_window(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 10_007).cast("double").alias("v"))
    found = rank_below(df, "v")
    assert "Cartesian" not in plan_text(found) and "NestedLoop" not in plan_text(found)
    # the only unpartitioned window follows an aggregation by range
    single = [line for line in plan_text(found, "simple").split("\n") if "SinglePartition" in line]
    assert len(single) == 1
    assert found.where("rank = 0").count() == df.where("v = 0").count()


def test_broadcasts_are_checked_by_bytes(spark):
    texts = spark.createDataFrame([("x" * 1000, ["y" * 500], 1)] * 10, "t STRING, a ARRAY<STRING>, n INT")
    assert fits_broadcast(texts, 10) and not fits_broadcast(texts, 10, 10_000)
    assert fits_broadcast(texts.select("n"), 10, 100) and fits_broadcast(texts.where("false"), 0, 0)
