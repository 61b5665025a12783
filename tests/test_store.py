import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rowjudge.operators.dedupe import split_fates
from rowjudge.operators.keys import entry_key
from rowjudge.operators.lookup import attach, hot_keys
from rowjudge.sources.answer_store import AnswerStore, keep_youngest
from rowjudge.sources.files import scratch_dir


@pytest.fixture
def store(spark, tmp_path):
    return AnswerStore(spark, str(tmp_path / "store"))


def answers(spark, keys, scope="s", value="a", model="m"):
    return spark.createDataFrame([(model, scope, "k", key, [value]) for key in keys],
                                 "model string, scope string, set_key string, entry_key string, answers array<string>")


def kept(store, **pruned):
    return {(r.entry_key, r.answers[0], r.seq, r.age) for r in store.latest(**pruned).collect()}


def test_a_new_answer_replaces_without_getting_younger(spark, store):
    assert kept(store) == set()
    assert store.append(answers(spark, ["x", "y"]), 2) == 1
    assert store.append(answers(spark, ["y", "z"], value="b"), 2) == 2
    assert kept(store) == {("x", "a", 1, 1), ("y", "b", 2, 1), ("z", "b", 2, 2)}
    assert store.compact(2) == 2  # oldest first, ties by key: x and y are of age 1, z stays
    assert kept(store) == {("x", "a", 1, 1), ("z", "b", 2, 2)}
    assert store.append(answers(spark, ["w"]), 1) == 3
    assert store.compact() == 3
    assert {k for k, *_ in kept(store)} == {"w", "x", "z"}
    store.vacuum()
    assert {k for k, *_ in kept(store)} == {"w", "x", "z"}


def test_scopes_and_models_are_apart_and_pruned(spark, store):
    store.append(answers(spark, ["x"], scope="101"), 1)
    store.append(answers(spark, ["y"], scope="202"), 1)
    store.append(answers(spark, ["z"], scope="202", model="m2"), 1)
    assert {k for k, *_ in kept(store, scope="202", model="m")} == {"y"}
    plan = store.latest(scope="202", model="m")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(scope,202)" in plan and "EqualTo(model,m)" in plan
    assert store.clear(scope="202") and {k for k, *_ in kept(store)} == {"x"}
    assert store.clear() and kept(store) == set()
    store.append(answers(spark, ["n"]), 1)
    assert {k for k, *_ in kept(store)} == {"n"}


def test_a_reader_keeps_its_runs(spark, store):
    store.append(answers(spark, ["x"]), 1)
    before = store.latest()
    store.clear()
    assert [r.entry_key for r in before.collect()] == ["x"]


def test_an_unfinished_append_is_not_read(spark, store, tmp_path):
    store.append(answers(spark, ["x"]), 1)
    debris = tmp_path / "store" / "run=000000002-000000002-000000002-0-1"
    debris.mkdir()
    assert {k for k, *_ in kept(store)} == {"x"}
    assert store.append(answers(spark, ["y"]), 1) == 3  # beside what the dead writer left
    assert {k for k, *_ in kept(store)} == {"x", "y"}
    store.vacuum()
    assert not debris.exists() and {k for k, *_ in kept(store)} == {"x", "y"}
    (tmp_path / "store" / "run=000000001-000000003-000000004-1-1").mkdir()  # a merge that died
    store.compact()
    assert {k for k, *_ in kept(store)} == {"x", "y"}


def hashed(*names):
    return [hashlib.sha256(n.encode()).hexdigest() for n in names]


def found(spark, store, keys):
    asked = spark.createDataFrame([(k,) for k in [*keys, None]], "entry_key string")
    return {(r.entry_key, r.answers[0], r.seq, r.age) for r in store.lookup(asked).collect()}


def test_a_lookup_reads_what_the_asked_keys_need(spark, store, monkeypatch):
    monkeypatch.setattr(AnswerStore, "rows_per_file", 10)
    keys = hashed(*map(str, range(400)))
    assert found(spark, store, keys[:3]) == set()
    store.append(answers(spark, keys), 400)
    store.append(answers(spark, keys[:40], value="b"), 40)
    few = spark.createDataFrame([(k,) for k in keys[:2] + hashed("nobody")], "entry_key string")
    every = spark.createDataFrame([(k,) for k in keys], "entry_key string")
    assert len(store.lookup(few).inputFiles()) < 10 < len(store.lookup(every).inputFiles())
    plan = store.lookup(few)._jdf.queryExecution().executedPlan().toString()
    assert 0 < plan.index("HashAggregate") < plan.index("LeftSemi") if "HashAggregate" in plan else plan.index("Aggregate") < plan.index("LeftSemi")
    assert found(spark, store, keys[:2] + hashed("nobody")) == {(k, "b", 2, 1) for k in keys[:2]}
    assert found(spark, store, keys[38:42]) == {(k, "b", 2, 1) for k in keys[38:40]} | {(k, "a", 1, 1) for k in keys[40:42]}
    assert found(spark, store, hashed("nobody")) == set()
    assert {(r.entry_key, r.answers[0], r.seq, r.age) for r in store.latest().collect()} == found(spark, store, keys)


def test_clearing_reads_no_answers(spark, store, tmp_path):
    store.append(answers(spark, hashed("x"), scope="101"), 1)
    store.append(answers(spark, hashed("y"), scope="202"), 1)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    started = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert store.clear("202")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == started  # no job at all
    assert {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")} == before
    assert found(spark, store, hashed("x", "y")) == {(hashed("x")[0], "a", 1, 1)}
    store.append(answers(spark, hashed("y"), scope="202", value="again"), 1)
    assert found(spark, store, hashed("x", "y")) == {(hashed("x")[0], "a", 1, 1), (hashed("y")[0], "again", 3, 3)}
    store.clear("101")
    assert store.compact() == 1 and found(spark, store, hashed("x", "y")) == {(hashed("y")[0], "again", 3, 3)}
    store.vacuum()
    assert not list((tmp_path / "store").glob("gone=*")) and len(list((tmp_path / "store").glob("run=*"))) == 1
    store.clear()
    store.vacuum()
    assert kept(store) == set() and store.append(answers(spark, hashed("z")), 1) == 4


def test_random_changes_equal_a_dictionary(spark, store, monkeypatch):
    """Appends, clearings, merges, evictions and vacuums in any order, against plain dictionaries."""
    monkeypatch.setattr(AnswerStore, "merge_runs", 3)
    rng, keys, model, seq = random.Random(7), hashed(*map(str, range(12))), {}, 0
    for step in range(40):
        what = rng.choice(["append"] * 6 + ["clear", "scope", "compact", "evict", "vacuum"])
        if what == "append":
            scope, chosen, seq = rng.choice(["a", "b"]), rng.sample(keys, rng.randint(1, 5)), seq + 1
            chosen = [k for k in chosen if int(k, 16) % 2 == (scope == "a")] or [next(k for k in keys if int(k, 16) % 2 == (scope == "a"))]
            assert store.append(answers(spark, chosen, scope=scope, value=str(step)), len(chosen)) == seq
            model |= {k: (str(step), seq, model[k][2] if k in model else seq) for k in chosen}
        elif what == "clear":
            store.clear()
            model = {}
        elif what == "scope":
            store.clear("a")
            model = {k: v for k, v in model.items() if int(k, 16) % 2 == 0}
        elif what == "evict":
            model = dict(sorted(model.items(), key=lambda kv: (-kv[1][2], kv[0]))[:3])
            assert store.compact(3) == len(model)
        elif what == "compact":
            assert store.compact() == len(model)
        else:
            store.vacuum()
        want = {(k, *v) for k, v in model.items()}
        if step % 4 == 0 or what != "append":
            assert kept(store) == want and found(spark, store, keys) == want, (step, what)
    assert kept(store) == {(k, *v) for k, v in model.items()}
    assert len(store.runs()) < 8


@pytest.mark.parametrize("limit", [0, 1, 37, 100, 299, 300, 1000])
def test_eviction_equals_a_sort(spark, limit):
    rng = random.Random(limit)
    rows = [(f"{rng.getrandbits(128):032x}", rng.choice([1, 2, 2, 2, 5])) for _ in range(300)]
    df = spark.createDataFrame(rows, "entry_key string, age bigint")
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:limit or None]
    assert sorted(map(tuple, keep_youngest(df, limit).collect())) == sorted(want)


def test_fates(spark):
    requests = spark.createDataFrame([("k1", "s", 2), ("k2", "s", 1), (None, "s", 3)], "entry_key string, scope string, n_rows int")
    known = spark.createDataFrame([("k1", ["a"]), ("none:s", ["b"])], "entry_key string, answers array<string>")
    got = {(r.entry_key, r.fate) for r in split_fates(requests, known.where("entry_key = 'k1'")).collect()}
    assert got == {("k1", "hit"), ("k2", "miss"), (None, "null")}


def test_keys_do_not_run_together(spark):
    def key(scope, model, set_key, payload):
        return spark.range(1).select(entry_key(*[F.lit(x).cast("string") for x in (scope, model, set_key, payload)])).first()[0]

    assert key("a", "m", "k", "p") == key("a", "m", "k", "p")
    keys = {key(*parts) for parts in [("a", "m", "k", "p"), ("a\x1f1:m", "m", "k", "p"), ("a", "m2", "k", "p"),
                                      ("a", "m", "k2", "p"), ("", "m", "k", "p"), ("a", "m", "k", "p2")]}
    assert len(keys) == 6 and key(None, "m", "k", "p") == key("", "m", "k", "p") and key("a", "m", "k", None) is None


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_keys_join_like_any_other(spark, broadcast):
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(
        F.lit("k"), F.col("id") % 500)).alias("key"))
    lookup = rows.select("key").where("key IS NOT NULL AND key <> 'k7'").distinct().withColumn("v", F.upper("key"))
    counts = rows.groupBy("key").agg(F.count("*").alias("n_rows"))
    hot = hot_keys(counts, "key")
    assert [tuple(r) for r in hot.collect()] == [("hot", 3)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if broadcast else "-1")
    try:
        for salt in (None, F.col("id")):
            got = attach(rows, lookup, "key", hot, salt)
            assert got.columns == ["key", "id", "v"] or set(got.columns) == {"id", "key", "v"}
            want = rows.join(lookup, "key", "left").select("id", "key", "v")
            assert got.select("id", "key", "v").exceptAll(want).count() == 0 and got.count() == 9000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scratch_is_the_shared_folder_when_there_is_one(spark, tmp_path):
    class Cluster:
        """As much of a session as the look-up reads."""

        class sparkContext:
            master = "spark://cluster"
            getConf = dict

    class Shared(Cluster):
        conf = {"spark.checkpoint.dir": f"{tmp_path}/"}

    class Unshared(Cluster):
        conf = {}

    assert scratch_dir(Shared) == f"{tmp_path}/rowjudge"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):  # no machine-local folder on a cluster
        scratch_dir(Unshared)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark) == f"{named}/rowjudge" if named else "rowjudge-" in scratch_dir(spark)
