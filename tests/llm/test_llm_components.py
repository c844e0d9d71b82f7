import random

from affinity.llm.components import components


def test_random_graphs_and_long_paths(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a path
    edges += [(2000, 2001 + i) for i in range(80)] + [(-5, 2050), (7, 7)]  # a hub, a loop
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame(edges + edges[:9] + [(None, 3)], "u bigint, v bigint")
    got = [(r["node"], r["root"]) for r in components(df).collect()]
    assert sorted(got) == sorted((x, find(x)) for x in linked)


def test_empty(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
