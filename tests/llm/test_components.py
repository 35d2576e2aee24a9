import random

from scholarlake.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if find(x) != x}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)]  # a chain
    edges += [(1, i) for i in range(200, 260)] + [(i, 1) for i in range(300, 330)]  # a hub
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(150)]
    edges += [(5, 5), (1, 200), (1, 200)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == plain(edges)
    assert len(got) == len(plain(edges))


def test_no_edges(spark):
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
