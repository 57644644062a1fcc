"""Connected components against a plain union of sets."""

import random

import pytest

from tallyforge.llm.components import components, more_components


def brute(edges):
    own = {}
    for a, b in edges:
        if a == b:
            continue
        merged = own.get(a, {a}) | own.get(b, {b})
        for x in merged:
            own[x] = merged
    return {x: min(s) for x, s in own.items()}


def table(spark, edges):
    return spark.createDataFrame(edges, "a long, b long").repartition(3)


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_like_sets(spark, shape):
    r = random.Random(5)
    edges = {
        "path": [(k, k + 1) for k in range(300)],
        "star": [(7, k) for k in range(200)] + [(1000 + k, 1000) for k in range(50)],
        "random": [(r.randrange(-200, 200), r.randrange(-200, 200)) for _ in range(220)] * 2,
        "empty": [(3, 3)],
    }[shape]
    got = {x.node: x.component for x in components(table(spark, edges)).collect()}
    assert got == brute(edges)
    more = [(r.randrange(-300, 400), r.randrange(-300, 400)) for _ in range(60)]
    more = [(a, b) for a, b in more if a != b]
    rows = more_components(components(table(spark, edges)), table(spark, more)).collect()
    assert len(rows) == len({x.node for x in rows}) and {x.node: x.component for x in rows} == brute(edges + more)
