from itertools import accumulate
from math import log

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowjudge.functions import answers as A
from rowjudge.functions.payload import value_payload
from rowjudge.judges import bayes, calibration
from rowjudge.judges.model import ModelJudge
from rowjudge.plans.run import judge_rows
from rowjudge.queries.trained import choices
from rowjudge.questions import CHOICE, SCORE, make_question, single
from pyspark.sql import functions as F


def test_log_odds_by_hand(spark):
    rows = [(1, "good fine good", True), (2, "bad", False), (3, "fine bad bad", False), (4, None, True), (5, "x", None)]
    model = bayes.train(spark.createDataFrame(rows, "id int, t string, y boolean"), "id", "t", "y")
    assert (model.words, model.words_yes, model.words_no, model.texts_yes, model.texts_no) == (3, 3, 4, 2, 2)
    asked = spark.createDataFrame([(7, "good  bad good new"), (8, ""), (9, None)], "id int, t string")
    got = {r.id: (r.n_known, r.log_odds) for r in model.log_odds(asked, "id", "t").collect()}
    want = 2 * (log(3 / 6) - log(1 / 7)) + log(1 / 6) - log(4 / 7)
    assert got[7][0] == 3 and abs(got[7][1] - want) < 1e-12 and got[8] == got[9] == (0, 0.0)


def test_a_learned_judge_in_a_run(spark):
    rows = [(i, f"{'sunny warm' if i % 2 else 'rain cold'} day{i}", i % 2 == 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "id int, t string, y boolean")
    model = bayes.train(docs.where("id < 20"), "id", "t", "y")

    def transform(items):
        keyed = items.withColumn("place", F.struct("batch_id", "at"))
        odds = model.log_odds(keyed.select("place", F.regexp_replace("payload", '"', " ").alias("t")), "place", "t")
        return odds.select("place.*", (1 / (1 + F.exp(-F.col("log_odds")))).alias("probability"))

    run = judge_rows(docs.where("id >= 20"), value_payload(docs, "t"), single(make_question("is the weather good?")), ModelJudge(transform))
    got = run.rows.select("y", (A.number_field(F.col("answers")[0], "noul") >= 0.5).alias("said")).collect()
    assert len(got) == 20 and all(r.y == r.said for r in got)


def test_label_probabilities_by_hand(spark):
    rows = [(1, "warm warm sea", "south"), (2, "cold ice", "north"), (3, "ice", "north"), (4, None, "east"), (5, "warm", None)]
    model = bayes.train_labels(spark.createDataFrame(rows, "id int, t string, y string"), "id", "t", "y")
    assert model.labels == ("east", "north", "south")
    asked = spark.createDataFrame([(7, "warm  ice warm new"), (8, ""), (9, None)], "id int, t string")
    got = {r.id: (r.n_known, r.probabilities) for r in model.probabilities(asked, "id", "t").collect()}
    raw = {"east": 2 / 7 * (1 / 4) ** 3, "north": 3 / 7 * (1 / 7) ** 2 * 3 / 7, "south": 2 / 7 * (3 / 7) ** 2 * 1 / 7}
    assert got[7][0] == 3 and got[7][1] == pytest.approx({k: v / sum(raw.values()) for k, v in raw.items()})
    assert got[8] == got[9] and got[8][0] == 0 and got[8][1] == pytest.approx({"east": 2 / 7, "north": 3 / 7, "south": 2 / 7})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_in_their_row_without_a_shuffle(spark):
    rows = [(1, " sea\tice sea\x0bsé "), (1, "sea"), (2, " \r\n"), (3, None), (4, "a\u00a0b \x1c")]
    found = bayes.words_of(spark.createDataFrame(rows, "id int, t string"), "id", "t")
    assert sorted(map(tuple, found.collect())) == [(1, "ice", 1), (1, "sea", 1), (1, "sea", 2), (1, "sé", 1), (4, "\x1c", 1), (4, "a\u00a0b", 1)]
    assert "Exchange" not in plan_of(found)


def test_words_beyond_an_arrow_batch(spark, monkeypatch):
    monkeypatch.setattr(bayes, "BATCH_WORDS", 5)
    rows = [(i, " ".join(f"w{j}" for j in range(i))) for i in range(12)]
    found = bayes.words_of(spark.createDataFrame(rows, "id int, t string"), "id", "t")
    assert sorted(map(tuple, found.collect())) == sorted((i, f"w{j}", 1) for i in range(12) for j in range(i))


def test_scoring_reads_the_word_table_not_the_texts_of_training(spark):
    docs = spark.createDataFrame([(1, "warm sea", True, "south"), (2, "ice", False, "north")], "id int, t string, y boolean, l string")
    assert "MapInArrow" not in plan_of(bayes.train(docs, "id", "t", "y").counts)
    assert "MapInArrow" not in plan_of(bayes.train_labels(docs, "id", "t", "l").weights)


def test_items_are_scored_by_number(spark):
    docs = spark.createDataFrame([(1, "warm sea", "south"), (2, "ice", "north")], "id int, t string, l string")
    items = spark.createDataFrame([("f" * 64, 0, '"sea"'), ("f" * 64, 1, '"ice ice"'), ("e" * 64, 0, '"sea"')], "batch_id string, at int, payload string")
    told = choices(bayes.train_labels(docs, "id", "t", "l"), items)
    got = {(r.batch_id, r.at): max(r.probabilities, key=r.probabilities.get) for r in told.collect()}
    assert got == {("f" * 64, 0): "south", ("f" * 64, 1): "north", ("e" * 64, 0): "south"}
    assert "hashpartitioning(place" not in plan_of(told) and "hashpartitioning(batch_id" not in plan_of(told)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "a", None)], "id int, t string, y string")
    with pytest.raises(ValueError, match="labels"):
        bayes.train_labels(none, "id", "t", "y")
    with pytest.raises(ValueError, match="calibrate"):
        calibration.fit(spark.createDataFrame([(None, True), (1.0, None)], "o double, y boolean"), "o", "y")


def test_the_likeliest_label_and_ties(spark):
    rows = [({"b": 0.4, "a": 0.4, "c": 0.2},), ({"b": 0.1, "c": 0.9},), (None,)]
    df = spark.createDataFrame(rows, "p map<string,double>")
    got = [r.b for r in df.select(bayes.likeliest(F.col("p")).alias("b")).collect()]
    assert [(b.label, b.probability) if b else None for b in got] == [("a", 0.4), ("c", 0.9), None]


def _judged(spark, probabilities, kind, options):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    judge = ModelJudge(lambda items: items.withColumn("probabilities", probabilities(F.col("payload"))))
    run = judge_rows(df, value_payload(df, "t"), single(make_question("how?", kind, options)), judge, on_failure="keep")
    return [r.a and r.a[0] for r in run.rows.orderBy("id").select(F.col("answers").alias("a")).collect()]


def _shares(payload):
    return F.create_map(F.lit("low"), F.when(payload == '"x"', 0.25).otherwise(0.5), F.lit("high"), F.when(payload == '"x"', 0.75).otherwise(0.5))


def test_a_model_chooses_and_scores(spark):
    chosen = _judged(spark, _shares, CHOICE, ["high", "low", "none"])
    assert chosen == ['{"type":"choice","choice":"high","probabilities":{"low":0.25,"high":0.75},"confidence":0.75}',
                      '{"type":"choice","choice":"high","probabilities":{"low":0.5,"high":0.5},"confidence":0.5}']
    scored = _judged(spark, _shares, SCORE, ["low", "middle", "high"])
    assert scored[0] == ('{"type":"score","score":1.5,"legend":{"0":"low","1":"middle","2":"high"},'
                         '"probabilities":{"0":0.25,"1":0.0,"2":0.75},"confidence":0.75}')


def test_a_model_with_other_labels_or_none_is_refused(spark):
    assert _judged(spark, _shares, CHOICE, ["low", "middle"]) == [None, None]
    assert _judged(spark, lambda p: F.lit(None).cast("map<string,double>"), CHOICE, ["low", "high"]) == [None, None]
    assert _judged(spark, _shares, "noul", None) == [None, None]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(0, 63), st.integers(1, 9).flatmap(lambda n: st.tuples(st.just(n), st.integers(0, n))), min_size=1, max_size=9))
def test_pooling_equals_max_of_min_of_means(counts):
    rows = [(step, n, yes) for step, (n, yes) in sorted(counts.items())]
    ns, ys = ([0, *accumulate(r[i] for r in rows)] for i in (1, 2))
    mean = lambda lo, hi: (ys[hi + 1] - ys[lo]) / (ns[hi + 1] - ns[lo])
    want = [max(min(mean(lo, hi) for hi in range(at, len(rows))) for lo in range(at + 1)) for at in range(len(rows))]
    assert [share for _, share in calibration.pooled(rows)] == pytest.approx(want)


def test_steps_without_rows_take_the_next_lower_share(spark):
    rows = [(-3.5, False), (-3.2, True), (0.0, False), (2.5, True), (None, True), (9.0, None)]
    model = calibration.fit(spark.createDataFrame(rows, "o double, y boolean"), "o", "y")
    asked = spark.createDataFrame([(-1e9,), (-2.0,), (0.5,), (2.0,), (1e9,), (None,)], "o double")
    got = [r[0] for r in asked.select(model.probability(F.col("o"))).collect()]
    assert got == [1 / 3, 1 / 3, 1 / 3, 1.0, 1.0, None]
