from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowjudge.llm import hnsw, product_quantisation as pq

SCHEMA = "vec_id long, embedding array<float>, label int, component_id long, score double"


def clustered(spark, n=1500, d=32, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for i in range(0, n // 3):  # near copies of a few vectors, and exact ones
        x[i] = x[n - 1 - i % 12] + (rng.normal(size=d) * 0.12 if i % 4 else 0)
    x = x.astype(np.float32)
    x[5] = x[40] * 3
    return x, spark.createDataFrame([(i, v.tolist(), 0, 1, 0.5) for i, v in enumerate(x)], SCHEMA)


def odd(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [1.0, float("nan"), 0.0]),
            (7, [float("inf"), 1.0, 1.0]), (8, [1.0, 2.0]), (9, []), (10, [-1.0, 0.5, 0.0]), (None, v), (11, None), (1, None)]
    return spark.createDataFrame([(i, e, 1, 2, 0.1) for i, e in rows], SCHEMA)


def test_links_equal_brute_force(spark):
    x, rows = clustered(spark)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r for r in pq.near_duplicates(rows, pq.PqConfig(block=64)).collect()}
    links = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (links <= linked.sum(1)).all() and links.sum() >= 0.99 * linked.sum()
    label = np.arange(len(x))
    for _ in range(50):
        label = np.minimum(label, np.where(linked, label, len(x)).min(1))
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) > 0.99
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_odd_vectors_link_with_nothing(spark):
    got = pq.near_duplicates(odd(spark)).collect()
    assert len(got) == 14
    pairs = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in got)
    assert pairs.count((2, 2, 1)) == 2 and (1, 2, 1) in pairs and (1, 0, 1) in pairs
    assert all((i, 0, i) in pairs for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)) and (0, 0, None) in pairs
    assert pq.near_duplicates(odd(spark).where("false")).count() == 0


@pytest.mark.parametrize("scale", [1, 4])
def test_recall_against_brute_force(spark, scale):
    x, rows = clustered(spark, 3000, 24, 2)
    x = x * np.linspace(1, scale, len(x), dtype=np.float32)[:, None]
    rows = spark.createDataFrame([(i, v.tolist(), 0, 1, 0.5) for i, v in enumerate(x)], SCHEMA)
    got = hnsw.nearest_neighbours(rows, F.pmod("vec_id", F.lit(20)) == 0, hnsw.HnswConfig(shard_rows=800)).collect()
    y = x.astype(float)
    hits = 0
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
        assert r["score"] == pytest.approx(float(y[r["query_id"]] @ y[r["vec_id"]]), abs=1e-12)
    for q in range(0, len(x), 20):
        score = y @ y[q]
        score[q] = -np.inf
        own = sorted(by[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 21))
        assert all(a["score"] > b["score"] or a["score"] == b["score"] and a["vec_id"] < b["vec_id"] for a, b in zip(own, own[1:]))
        hits += sum(score[r["vec_id"]] >= np.sort(score)[-20] - 1e-12 for r in own)
    assert hits >= 0.95 * len(got) and len(got) == 20 * len(range(0, len(x), 20))


def test_few_and_odd_vectors(spark):
    got = sorted(map(tuple, hnsw.nearest_neighbours(odd(spark), F.lit(True)).collect()))
    assert got == [(1, 1, 2, 14.0), (1, 2, 10, 0.0), (2, 1, 1, 14.0), (2, 2, 10, 0.0), (10, 1, 1, 0.0), (10, 2, 2, 0.0)]
    assert hnsw.nearest_neighbours(odd(spark).where("false"), F.lit(True)).count() == 0
