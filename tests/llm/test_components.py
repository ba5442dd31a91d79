import random

import pytest
from flowframe.llm.components import connected_components


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("kind", ["path", "star", "random", "cliques"])
def test_components_match_union_find(spark, kind):
    draw = random.Random(3)
    links = {
        "path": [(i, i + 1) for i in range(300)],
        "star": [(5000, i) for i in range(400)],
        "random": [(draw.randrange(400), draw.randrange(400)) for _ in range(250)],
        "cliques": [(c * 10 + i, c * 10 + j) for c in range(20) for i in range(8) for j in range(i)],
    }[kind]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {k: v for k, v in brute([x for x in links if x[0] != x[1]]).items()}


def test_no_links(spark):
    links = spark.createDataFrame([(1, 1), (None, 2)], "src long, dst long")
    assert connected_components(links).collect() == []
