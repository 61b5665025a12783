from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from rowjudge.llm import mixing


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_permutations_are_bijections(n):
    got = mixing.permutation(np.arange(n), n, 9)
    assert sorted(got) == list(range(n))
    assert n < 60 or (got != mixing.permutation(np.arange(n), n, 10)).any()


def test_targets():
    assert mixing.targets([100, 100, 100]) == [300 * 5 / 8, 300 * 2 / 8, 300 / 8]
    assert mixing.targets([10, 200, 0, 90]) == pytest.approx([30, 270 * 2 / 7, 0, 270 * 5 / 7])
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    assert mixing.targets([5]) == [5]
    for sizes in ([1, 1000, 3, 50, 2], [7] * 9, [1, 10**9]):
        got = mixing.targets(sizes)
        assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes))


def test_the_mix_meets_its_targets(spark):
    rows = [(i, " ".join(["w"] * (20 + i * 37 % 400)), ("a", "b", "c", None)[i % 10 % 4]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cfg = mixing.MixConfig(block=64, shard=50)
    got = mixing.mix(docs, cfg).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(600))
    sums: dict = {}
    source = {i: s for i, _, s in rows}
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["size"] == 20 + r["doc_id"] * 37 % 400
        own = sums.setdefault(source[r["doc_id"]], [0, 0, r["source_size"], r["target"]])
        own[0] += r["taken"]
        own[1] += r["size"]
    for taken, size, told, target in sums.values():
        assert size == told and abs(taken - target) <= 96  # half a block, and a last block that is not full
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(7), cfg).collect()))


def test_slots_are_blocks_by_permutation(spark):
    """Brute force: each pass over a source takes each block once, and the shards get their draws."""
    rows = [(i, " ".join(["w"] * 100), "ab"[i % 3 // 2]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cfg = mixing.MixConfig(block=50, shard=20)
    sources = mixing._sources(mixing._sized(docs), cfg)
    slots = mixing.draw_slots(spark, sources, cfg).collect()
    for s in sources.itertuples():
        times = np.bincount([r["block"] for r in slots if r["s"] == s.s], minlength=s.blocks)
        assert times.sum() == s.slots and times.max() - times.min() <= 1 and len(times) == s.blocks
    drawn = {(r["s"], r["shard"]): r["n"] for r in mixing._draws(spark, sources, cfg).collect()}
    laid = Counter((r["s"], r["shard"]) for r in slots)
    for s in sources.itertuples():
        own = {shard: n for (i, shard), n in drawn.items() if i == s.s}
        surplus = sum(own.values()) >= s.slots  # what is drawn too much is dropped, what is missing is dealt
        assert all(laid[s.s, shard] <= n if surplus else laid[s.s, shard] >= n for shard, n in own.items())
        assert not surplus or {shard for i, shard in laid if i == s.s} <= own.keys()
    told = mixing.mix(docs, cfg).collect()
    for s in sources.itertuples():
        into = {shard for r in told if rows[r["doc_id"]][2] == s.source for shard in r["shards"]}
        assert into == {shard for i, shard in laid if i == s.s}


def test_slots_are_spread_over_tasks(spark):
    rows = [(i, " ".join(["w"] * 100), "a") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cfg = mixing.MixConfig(block=10, shard=20, task_slots=50)
    sources = mixing._sources(mixing._sized(docs), cfg)
    slots = mixing.draw_slots(spark, sources, cfg)
    assert slots.rdd.getNumPartitions() == -(-int(sources["slots"].sum()) // 50)


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(5 + i * 31 % 90)), "abc"[i % 3], "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _row string")
    cfg = mixing.MixConfig(block=16)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, cfg).collect()}
    out = mixing.mixed_documents(docs, cfg)
    assert out.columns == docs.columns
    words: dict[int, int] = {}
    for r in out.collect():
        assert set(r["text"].split()) <= set(rows[r["doc_id"]][1].split()) and r["text"]
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == {k: v for k, v in taken.items() if v}


def test_odd_rows(odd_docs, no_docs):
    got = mixing.mix(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
