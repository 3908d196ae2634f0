import random

from pyspark.sql import functions as F

from catlink.functions.runtime import lookup
from catlink.operators.components import connected_components


def test_components_match_union_find(spark):
    random.seed(5)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)] + [(7, 7), (5000, 5000), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_hubs_are_looked_up_apart(spark):
    edges = [(1, i) for i in range(2, 9000)] + [(i, 20_000) for i in range(8000, 9000)] + [(30_000 + i, 30_001 + i) for i in range(0, 400, 2)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 1 for i in range(1, 9000)}, 20_000: 1, **{30_000 + i: 30_000 + i - i % 2 for i in range(400)}}


def test_lookup_equals_a_join(spark):
    left = spark.createDataFrame([(7 if i % 3 else i, i) for i in range(6000)], "k long, v long")
    right = left.groupBy("k").agg(F.count("*").alias("_n"), F.max("v").alias("m"))
    want = sorted(map(tuple, left.join(right.drop("_n"), "k").select("k", "v", "m").collect()))
    assert sorted(map(tuple, lookup(left, right, "k", 6000).select("k", "v", "m").collect())) == want
    assert sorted(map(tuple, lookup(left, right, "k", 10).select("k", "v", "m").collect())) == want
