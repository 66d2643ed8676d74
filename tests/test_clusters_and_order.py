import random

import pytest
from pyspark.sql import functions as F

from quakespark.operators import cluster
from quakespark.operators.order import number_rows
from quakespark.operators.weights import exact_median


def components(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(30)],                                     # a chain
    [(500, i) for i in range(40)] + [(900, 901)],                        # a hub and a pair
    [tuple(random.Random(i).sample(range(80), 2)) for i in range(60)],   # random
])
def test_components(spark, edges):
    got = cluster.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in got.collect()} == components(edges)


def test_clusters_without_threshold_and_without_edges(spark):
    events = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    links = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "id1 long, id2 long, idx int")
    one = cluster.cluster_events(links, events, 0, 0).collect()
    assert {r.cluster_id for r in one} == {1}
    none = cluster.cluster_events(links, events, 0, 3).collect()
    assert {r.cluster_id for r in none} == {None}
    two = {r.id: r.cluster_id for r in cluster.cluster_events(links, events, 0, 2).collect()}
    assert two == {1: 1, 2: 1, 3: None}


def test_numbers_follow_the_order(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    got = {r.v: r.n for r in number_rows(df, ["v"], "n", 5).collect()}
    assert got == {v: i + 5 for i, v in enumerate(sorted(values))}


@pytest.mark.parametrize("accuracy", [20, 10000])
def test_exact_median(spark, accuracy):
    rng = random.Random(2)
    groups = {
        "one": [3.5], "two": [1.0, 2.0], "even": [rng.gauss(0, 1) for _ in range(500)],
        "odd": [rng.gauss(0, 1) for _ in range(333)], "ties": [rng.choice([0.0, 1.0, 2.0]) for _ in range(400)],
        "hot": [7.0] * 300 + [rng.random() for _ in range(100)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double").repartition(5)
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", accuracy).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert got == pytest.approx(want)
