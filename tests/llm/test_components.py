from __future__ import annotations

import random

import numpy as np

from rowjudge.llm.common import components, roots, with_offsets


def union_find(edges):
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for e in edges for n in e}


def test_components_equal_union_find(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 280)] + \
            [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = [(a, b) for a, b in edges if a != b]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(9)).collect()
    assert {r["node"]: r["component_id"] for r in got} == union_find(edges) and len(got) == len({n for e in edges for n in e})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    nodes, root = roots(*np.array(edges).T)
    assert dict(zip(nodes.tolist(), root.tolist())) == union_find(edges)


def test_offsets_are_running_totals(spark):
    rows = [("hot" if i % 3 else str(i % 7) if i % 2 else None, i, i % 11) for i in range(500)]
    got = with_offsets(spark.createDataFrame(rows, "g string, i long, n long"), ["g"], ["i"], "n").collect()
    total: dict = {}
    want = {}
    for g, i, n in rows:
        want[i] = total.get(g, 0)
        total[g] = want[i] + n
    assert {r["i"]: r["pos"] for r in got} == want
