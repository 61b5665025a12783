from __future__ import annotations

from rowjudge.llm.sharding import ShardConfig, balanced_shards


def check(docs, cfg):
    rows = balanced_shards(docs, cfg).collect()
    assert len(rows) == docs.count()
    slots: dict[int, list[int]] = {h: [] for h in range(cfg.shards)}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    return rows


def test_groups_stay_together(spark):
    rows = [(i, f"single {i}") for i in range(600)] + [(1000 + i, f"group {i % 60}") for i in range(300)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), ShardConfig(shards=6))
    text = dict(rows)
    where: dict[str, set] = {}
    for r in got:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) == 0


def test_a_group_larger_than_a_shard_fills_few(spark):
    rows = [(i, "hot" if i % 3 else f"t{i}") for i in range(900)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), ShardConfig(shards=9))
    assert len({r["shard"] for r in got if r["doc_id"] % 3}) == 6


def test_nothing_but_groups(spark):
    rows = [(i, f"g{i // 4}") for i in range(400)]
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), ShardConfig(shards=5))
    where: dict[int, set] = {}
    for r in got:
        where.setdefault(r["doc_id"] // 4, set()).add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) <= 25  # random places would cut 99 of the 100


def test_odd_rows(odd_docs, no_docs):
    rows = check(odd_docs, ShardConfig())
    sizes = {r["doc_id"]: r["size"] for r in rows}
    assert sizes[1] == sizes[2] == 8 and sizes[11] == 10_008
    assert balanced_shards(no_docs).count() == 0


def cut_groups(spark, rows, shards):
    got = check(spark.createDataFrame(rows, "doc_id long, text string"), ShardConfig(shards=shards))
    text = dict(rows)
    where: dict[str, set] = {}
    for r in got:
        where.setdefault(text[r["doc_id"]], set()).add(r["shard"])
    return sum(len(s) > 1 for t, s in where.items() if t != "hot")


def test_nothing_but_groups_cuts_few(spark):
    assert cut_groups(spark, [(i, f"g{i // 4}") for i in range(400)], 5) <= 10


def test_pairs_stay_together_beside_a_hot_third(spark):
    pairs = [(10_000 + i, f"pair {i // 2}") for i in range(1600)]
    rows = [(i, "hot") for i in range(1200)] + pairs + [(20_000 + i, f"single {i}") for i in range(800)]
    assert cut_groups(spark, rows, 12) <= 12  # 800 pairs; at most the ends of shards cut one
