import random

import pytest
from pyspark.sql import functions as F

from skytally.operators import graph, links
from skytally.plans.inspect import plan_text
from skytally.sources.text import parse_adjacency
from tests.conftest import rows

GRAPH = ("0 1 2", "1 0 2", "2 0 1 3 4", "3 1 2 4 6", "4 2 3 5 6", "5 4", "6 3 4", "7 8 9", "8 7 9", "9 7 8")


def brute_components(ids, edges):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted(label.items())


def brute_hops(ids, edges, source):
    hops, level = {source: 0} if source in ids else {}, {source} & set(ids)
    while level:
        level = {b for a, b in edges if a in level} - set(hops)
        hops.update({b: max(hops.values()) + 1 for b in level})
    return sorted(((i, hops.get(i)) for i in ids), key=repr)


def frames(spark, ids, edges):
    return spark.createDataFrame([(i,) for i in ids], "id BIGINT"), spark.createDataFrame(edges or [], "src BIGINT, dst BIGINT")


def test_links(spark):
    df = spark.createDataFrame([(1, 2), (3, 2), (4, 4), (3, 1)], "src BIGINT, dst BIGINT")
    assert rows(links.vertices(df)) == [(1,), (2,), (3,), (4,)]
    assert rows(links.inlink_count(df)) == [(1, 1), (2, 2), (3, 0), (4, 1)]
    assert rows(links.orphan_pages(df)) == [(3,)]  # a page that links to itself is none
    assert rows(links.top_popular_links(df, 2), "kept") == [(2, 2), (4, 1)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_league(spark, monkeypatch, broadcast):
    monkeypatch.setattr("skytally.operators.links.fits_broadcast", lambda df: broadcast)
    df = spark.createDataFrame([(1, 2), (3, 2), (4, 5), (4, 1), (9, 6), (8, 6), (7, 6)], "src BIGINT, dst BIGINT")
    league = spark.createDataFrame([(2,), (5,), (1,), (3,), (100,)], "id BIGINT")  # 100 does not occur
    assert rows(links.popularity_league(df, league)) == [(1, 1), (2, 3), (3, 0), (5, 1)]


def test_bundled_graph(spark, lines):
    edges = parse_adjacency(lines(*GRAPH)).select("src", "dst")
    ids = links.vertices(edges)
    assert rows(graph.connected_components(ids, edges)) == [(i, 0) for i in range(7)] + [(i, 7) for i in (7, 8, 9)]
    hops = {3: 0, 2: 1, 1: 1, 4: 1, 6: 1, 0: 2, 5: 2, 7: None, 8: None, 9: None}
    assert rows(graph.shortest_paths(ids, edges, 3)) == sorted(hops.items(), key=repr)
    marked = dict(rows(graph.shortest_paths(ids, edges, 3, integer_unreachable=True)))
    assert marked[7] == graph.UNREACHABLE and marked[5] == 2


@pytest.mark.parametrize("rows_per_task", [10**9, 3])
def test_components_match_brute_force(spark, rows_per_task):
    rng = random.Random(7)
    ids = list(range(60))
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(35)]
    edges += [(50, i) for i in range(20)]                        # a hub with a large share of the edges
    edges += [(i, i + 1) for i in range(30, 40)] + [(5, 5)]      # a path and a loop
    found = graph.connected_components(*frames(spark, ids, edges), rows_per_task=rows_per_task)
    assert rows(found) == sorted(brute_components(ids, edges), key=repr)


def test_components_of_a_long_path_and_of_no_edges(spark):
    path = [(i, i + 1) for i in range(40)]
    assert {c for _, c in rows(graph.connected_components(*frames(spark, range(41), path)))} == {0}
    assert rows(graph.connected_components(*frames(spark, [3, 4], []))) == [(3, 3), (4, 4)]


@pytest.mark.parametrize("rows_per_task", [10**9, 3])
def test_hops_match_brute_force(spark, rows_per_task):
    rng = random.Random(3)
    ids = list(range(30))
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(40)] + [(0, i) for i in range(5, 15)]
    found = graph.shortest_paths(*frames(spark, ids, edges), 0, rows_per_task=rows_per_task)
    assert rows(found) == brute_hops(ids, edges, 0)


def test_hops_beyond_the_merged_levels_and_from_a_missing_source(spark):
    path = [(i, i + 1) for i in range(20)]
    assert rows(graph.shortest_paths(*frames(spark, range(21), path), 0)) == sorted([(i, i) for i in range(21)], key=repr)
    assert rows(graph.shortest_paths(*frames(spark, [1, 2], [(1, 2)]), 99)) == [(1, None), (2, None)]


def test_large_levels_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(graph, "_FEW", 0)
    edges = spark.createDataFrame([(i // 2, i) for i in range(1, 200)], "src INT, dst INT")
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = graph.shortest_paths(vertices, edges, 1)
    assert {tuple(r) for r in found.collect()} == {(0, None), *((i, i.bit_length() - 1) for i in range(1, 200))}
    assert "Broadcast" not in plan_text(found)
