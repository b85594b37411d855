"""Connected components against union-find."""

import random

from quarterline.llm import common


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    edges += [(5000, 5000 + i) for i in range(1, 80)] + [(7, 7), (-5, 3), (2 ** 62, -2 ** 62)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    want = {x: top(x) for e in edges if e[0] != e[1] for x in e}
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
