import random

from lossline.llm.components import components


def _brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_random_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randint(200, 320), rng.randint(200, 320)) for _ in range(90)]
    edges = [(u, v) for u, v in edges if u != v]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges * 2, "u long, v long")).collect()}
    assert got == _brute(edges)


def test_no_edges_and_loops(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert components(spark.createDataFrame([(3, 3)], "u long, v long")).count() == 0
