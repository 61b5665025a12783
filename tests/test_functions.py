import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from rowjudge.config import JudgeConfig
from rowjudge.functions import answers as A
from rowjudge.functions import judging as J
from rowjudge.functions.payload import row_payload, value_payload
from rowjudge.questions import QuestionError, parse_questions

TEAMS = ["billing", "technical", "sales"]
CODER = "the person builds sailboats"


def column(df, expression):
    return [r[0] for r in df.orderBy("id").select(expression).collect()]


def test_probability_and_threshold(people):
    p = row_payload(people)
    assert column(people, J.probability(p, CODER)) == [0.9, 0.1, 0.1]
    assert [r.id for r in people.where(J.holds(p, CODER)).collect()] == [1]
    assert people.where(J.holds(p, CODER, 0.95)).count() == 0
    assert people.where(J.holds(p, CODER, cfg=JudgeConfig(threshold=0.05))).count() == 3
    assert people.where(J.holds(p, CODER, F.lit(None).cast("double"))).count() == 1
    assert people.where(J.holds(row_payload(people, ["name"]), "the person is Ina")).count() == 1
    assert people.where(J.holds(value_payload(people, "name"), "the name is Ina")).count() == 1


def test_choice_score_confidence(people):
    p = row_payload(people)
    length = F.length(p)
    assert column(people, J.choice(p, "which team?", TEAMS)) == [TEAMS[n % 3] for n in column(people, length)]
    assert column(people, J.score(p, "how senior?", TEAMS)) == [float(n % 3) for n in column(people, length)]
    assert column(people, J.score_norm(p, "how senior?", TEAMS)) == [n % 3 / 2 for n in column(people, length)]
    assert column(people, J.score_norm(p, "how senior?", ["one"])) == [0.0] * 3
    assert column(people, J.confidence(p, "which team?", "choice", TEAMS)) == [1.0] * 3
    assert column(people, J.confidence(p, "which team?", "noul", None)) == [None] * 3


def test_choice_at_a_known_length(spark):
    # the compact payload {"name":"Ina"} has 14 characters
    df = spark.createDataFrame([(1, "Ina")], "id int, name string")
    assert column(df, J.choice(row_payload(df, ["name"]), "which team?", ["billing", "sales"])) == ["billing"]
    assert column(df, J.choice(row_payload(df, ["name"]), "which team?", "[billing, technical]")) == ["billing"]


def test_full_answers(people):
    p = row_payload(people)
    assert json.loads(column(people, J.evaluate(p, CODER))[0]) == {"type": "noul", "noul": 0.9}
    answer = json.loads(column(people, J.evaluate(p, "how senior?", "SCORE", ["junior", "mid"]))[0])
    assert list(answer) == ["type", "score", "legend", "probabilities", "confidence"]
    assert answer["legend"] == {"0": "junior", "1": "mid"}
    with pytest.raises(QuestionError, match="needs its options"):
        J.evaluate(p, "which team?", "choice")
    with pytest.raises(QuestionError, match="unknown question kind"):
        J.evaluate(p, "how European?", "rubric", ["a", "b"])


def test_nulls_in_nulls_out(people):
    p, none = row_payload(people), F.lit(None).cast("string")
    for result in (J.probability(none, CODER), J.probability(p, None), J.probability(p, none), J.holds(none, CODER),
                   J.choice(none, "?", TEAMS), J.choice(p, "?", None), J.choice(p, None, TEAMS),
                   J.choice(p, "?", F.lit(None).cast("array<string>")), J.score(none, "?", TEAMS),
                   J.score_norm(none, "?", TEAMS), J.confidence(none, "?", "choice", TEAMS),
                   J.evaluate(none, CODER), J.evaluate(p, None), J.evaluate(p, "?", None, TEAMS),
                   J.evaluate(none, "?", "choice", TEAMS), J.ask_json(none, {"q": {"type": "noul", "question": "?"}}),
                   J.ask_json(p, None), J.intent_of_payload(none)):
        assert column(people, result) == [None] * 3


def test_options_in_a_column(spark):
    df = spark.createDataFrame([(1, "x", ["a", "b"]), (2, "y", ["c"]), (3, "z", None)], "id int, t string, o array<string>")
    p = value_payload(df, "t")
    assert column(df, J.choice(p, "?", F.col("o"))) == ["b", "c", None]
    assert column(df, J.score_norm(p, "?", F.col("o"))) == [1.0, 0.0, None]
    bad = spark.createDataFrame([(1, "x", ["a", None])], "id int, t string, o array<string>")
    with pytest.raises(Exception, match="NULL among its options"):
        column(bad, J.choice(value_payload(bad, "t"), "?", F.col("o")))
    empty = spark.createDataFrame([(1, "x", [])], "id int, t string, o array<string>")
    with pytest.raises(Exception, match="at least one option"):
        column(empty, J.choice(value_payload(empty, "t"), "?", F.col("o")))
    with pytest.raises(AnalysisException):  # a text column is no list of labels
        column(df, J.choice(p, "?", F.col("t")))


def test_options_of_any_type_in_a_column(spark):
    df = spark.sql("""SELECT id, t, array('a', 'b', 'c') AS l, map('a', 'first', 'b', NULL, 'c', '') AS m, named_struct('a', 1, 'b', CAST(NULL AS INT), 'c', 2) AS s,
        parse_json('["a", "b", "c"]') AS v, parse_json('{"a": "first", "b": null, "c": "x"}') AS w FROM VALUES (1, 'x'), (2, 'yy'), (3, 'zzz') AS d(id, t)""")
    p = value_payload(df, "t")
    want = column(df, J.choice(p, "?", ["a", "b", "c"]))
    for name in "lmsvw":
        assert column(df, J.choice(p, "?", F.col(name))) == want, name
    assert column(df, J.score_norm(p, "?", F.col("m"))) == column(df, J.score_norm(p, "?", ["a", "b", "c"]))
    empty = spark.sql("SELECT 1 AS id, 'x' AS t, CAST(map() AS MAP<STRING, STRING>) AS m")
    with pytest.raises(Exception, match="at least one option"):
        column(empty, J.choice(value_payload(empty, "t"), "?", F.col("m")))


def test_descriptions_are_part_of_a_question(spark):
    told = [json.loads(spark.sql(f"SELECT {m} AS m").select(J.question_text("choice", "which?", F.col("m"))).first()[0])
            for m in ("map('a', 'x', 'b', NULL)", "map('a', 'y', 'b', NULL)", "array('a', 'b')")]
    assert told[0] == {"q": {"type": "choice", "question": "which?", "options": {"a": "x", "b": None}}}
    assert len({parse_questions(t).set_key for t in told}) == 3
    level = spark.range(1).select(J.question_text("SCORE", F.lit('how "far"?'), F.array(F.lit("l"), F.lit("h")), name="far")).first()[0]
    assert parse_questions(level).questions[0].options == ("l", "h") and parse_questions(level).questions[0].query == 'how "far"?'


def test_ask_keeps_question_order(people):
    questions = {"team": {"type": "choice", "question": "which team?", "options": TEAMS},
                 "coder": {"type": "noul", "question": CODER, "criteria": {"true": "y", "false": "n"}},
                 "senior": {"type": "score", "question": "how senior?", "levels": ["junior", "mid", "senior"]}}
    p = row_payload(people)
    answers = [json.loads(a) for a in column(people, J.ask_json(p, questions))]
    assert [list(a) for a in answers] == [["team", "coder", "senior"]] * 3
    assert [a["coder"]["noul"] for a in answers] == [0.9, 0.1, 0.1]
    assert list(answers[0]["team"]["probabilities"]) == TEAMS
    assert column(people, J.ask(p, json.dumps(questions))["coder"]["noul"]) == [0.9, 0.1, 0.1]


def test_prompt_intent_takes_text_only(spark, prompts):
    kind = prompts.select(J.prompt_intent(prompts, "user_prompt").alias("r")).schema["r"].dataType.simpleString()
    assert kind == ("struct<intent:string,intent_confidence:double,intent_probabilities:map<string,double>,"
                    "malicious_probability:double>")
    nested = spark.sql("SELECT named_struct('a', 'b') AS s, 1 AS n")
    for name in ("s", "n"):
        with pytest.raises(TypeError, match="takes a text column"):
            J.prompt_intent(nested, name)


def test_prompt_intent_values(prompts):
    judged = J.with_prompt_intent(prompts, "user_prompt")
    assert judged.columns == ["id", "user_prompt", "r"]
    top = judged.groupBy((F.col("id") % 4 == 0).alias("flagged")).agg(F.max("r.malicious_probability")).collect()
    assert dict(map(tuple, top)) == {False: 0.1, True: 0.9}
    first = judged.orderBy("id").first()["r"]
    assert list(first["intent_probabilities"]) == ["work_related", "personal", "other"]
    assert first["intent_probabilities"][first["intent"]] == 1.0


def test_answer_fields(spark):
    df = spark.createDataFrame([
        ('{"noul": 0.5, "choice": "a", "probabilities": {"z": 0.25, "a": "x", "b": 1}}',),
        ('{"noul": "0.5", "choice": 5, "probabilities": [1]}',), ('{"noul": null}',), (None,)], "a string")
    a = F.col("a")
    rows = df.select(A.number_field(a, "noul"), A.text_field(a, "choice"), A.probabilities(a)).collect()
    assert [tuple(r) for r in rows] == [(0.5, "a", {"z": 0.25, "b": 1.0}), (None, None, None), (None, None, None),
                                        (None, None, None)]
    assert list(rows[0][2]) == ["z", "b"]
    broken = spark.createDataFrame([("{nope",)], "a string")
    with pytest.raises(Exception, match="an answer is no JSON"):
        broken.select(A.number_field(a, "noul")).collect()


def test_kind_and_questions_per_row(people):
    p = row_payload(people)
    kind = F.when(F.col("id") == 1, "NOUL").when(F.col("id") == 2, "choice")
    got = column(people, J.evaluate(p, CODER, kind, ["a", "b"]))
    assert [g and json.loads(g)["type"] for g in got] == ["noul", "choice", None]
    with pytest.raises(Exception, match="unknown question kind rubric"):
        column(people, J.evaluate(p, CODER, F.lit("rubric"), ["a"]))
    one = '{"b": {"type": "noul", "question": "is murals"}, "a": {"type": "choice", "question": "?", "options": ["x"]}}'
    asked = J.with_asked(people, p, F.when(F.col("id") == 3, one)).orderBy("id")
    assert [r.answers for r in asked.collect()][:2] == [None, None]
    answer = json.loads(asked.collect()[2].answers)
    assert list(answer) == ["b", "a"] and answer["b"]["noul"] == 0.9 and answer["a"]["choice"] == "x"


def test_session_threshold_acts(spark, people):
    payload = row_payload(people)
    assert column(people, J.holds(payload, "the person builds sailboats"))[0] is True
    spark.conf.set("rowjudge.threshold", "0.95")
    try:
        assert column(people, J.holds(payload, "the person builds sailboats"))[0] is False
    finally:
        spark.conf.unset("rowjudge.threshold")
