from __future__ import annotations

import random

from flowgauge.llm.graph import components


def brute(edges):
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in parent}


def test_random_graphs_loops_and_repeats(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += edges[:20] + [(9, 9), (500, 501), (501, 500)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = brute([e for e in edges if e[0] != e[1]])
    assert {r.node: r.component for r in found} == want
    assert len(found) == len(want)


def test_star_with_text_nodes_and_nulls(spark):
    edges = [("hub", f"n{i}") for i in range(500)] + [("a", None), (None, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert set(found.values()) == {"hub"} and len(found) == 501


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
