import json

import pytest
from pyspark.sql.utils import AnalysisException

from rowjudge.functions import judging as J
from rowjudge.functions.payload import row_payload, value_payload
from rowjudge.functions.sql import register, register_ask

ROW = "to_json(struct(p.*), map('ignoreNullFields', 'false'))"


@pytest.fixture(scope="module")
def sql(spark, people, prompts):
    people.createOrReplaceTempView("people")
    prompts.createOrReplaceTempView("prompts")
    register(spark, generic=True)
    return lambda text: [r[0] for r in spark.sql(text).collect()]


def test_only_the_fixed_questions_exist_by_default(spark):
    session = spark.newSession()
    register(session)
    assert session.sql("SELECT prompt_intent('hello').intent").first()[0] == "personal"
    with pytest.raises(AnalysisException):
        session.sql("SELECT judge_prob('1', 'y')")


def test_predicate_and_probability(sql):
    assert sql(f"SELECT id FROM people p WHERE judge({ROW}, 'the person builds sailboats')") == [1]
    assert sql(f"SELECT judge_prob({ROW}, 'the person builds sailboats') FROM people p ORDER BY id") == [0.9, 0.1, 0.1]
    assert sql(f"SELECT count(*) FROM people p WHERE judge({ROW}, 'the person builds sailboats', 0.95)") == [0]
    assert sql("SELECT count(*) FROM people WHERE judge(text_payload(name), 'the name is Ina', NULL)") == [1]
    assert sql("SELECT judge(NULL, 'x'), judge_prob('1', NULL)") == [None]


def test_the_same_answers_as_the_columns(sql, people):
    p, teams = row_payload(people), ["billing", "technical", "sales"]
    columns = {
        "judge_choice": J.choice(p, "?", teams), "judge_score": J.score(p, "?", teams),
        "judge_score_norm": J.score_norm(p, "?", teams)}
    for name, column in columns.items():
        want = [r[0] for r in people.orderBy("id").select(column).collect()]
        assert sql(f"SELECT {name}({ROW}, '?', array('billing', 'technical', 'sales')) FROM people p ORDER BY id") == want
    assert sql("SELECT judge_confidence('1', '?', 'choice', array('a'))") == [1.0]
    for kind in ("noul", "Score", "choice"):
        want = [r[0] for r in people.orderBy("id").select(J.evaluate(p, "is murals", kind, teams)).collect()]
        assert sql(f"SELECT judge_eval({ROW}, 'is murals', '{kind}', array('billing', 'technical', 'sales')) "
                   "FROM people p ORDER BY id") == want


def test_refusals(sql):
    for call, message in [("judge_eval('1', '?', 'rubric')", "unknown question kind"),
                          ("judge_eval('1', '?', 'choice')", "needs its options"),
                          ("judge_choice('1', '?', array())", "at least one option"),
                          ("judge_confidence('1', '?', 'choice', array())", "at least one option"),
                          ("judge_confidence('1', '?', 'score', array('a', NULL))", "NULL among its options"),
                          ("judge_confidence('1', '?', 'rubric', array('a'))", "unknown question kind"),
                          ("judge_choice('1', '?', array('a', NULL))", "NULL among its options")]:
        with pytest.raises(Exception, match=message):
            sql(f"SELECT {call}")
    assert sql("SELECT judge_choice('1', '?', NULL)") == [None]


def test_prompt_intent(sql, prompts):
    want = [r[0] for r in J.with_prompt_intent(prompts, "user_prompt").orderBy("id").select("r").collect()]
    assert sql("SELECT prompt_intent(user_prompt) FROM prompts ORDER BY id") == want
    assert sql("SELECT prompt_intent(NULL)") == [None]


def test_ask(spark, sql, people):
    questions = {"team": {"type": "choice", "question": "what's the team?", "options": {"a": "x", "b'c": None}},
                 "coder": {"type": "noul", "question": "the person builds sailboats"}}
    register_ask(spark, "ask_team", questions)
    want = [r[0] for r in people.orderBy("id").select(J.ask_json(value_payload(people, "note"), questions)).collect()]
    got = sql("SELECT ask_team(text_payload(note)) FROM people ORDER BY id")
    assert got == want and list(json.loads(got[0])) == ["team", "coder"]


def test_options_as_maps(sql, people):
    teams = "map('billing', 'money', 'technical', CAST(NULL AS STRING), 'sales', '')"
    for name, more in (("judge_choice", ""), ("judge_score", ""), ("judge_score_norm", ""), ("judge_confidence", "'choice', "), ("judge_eval", "'score', ")):
        want = sql(f"SELECT {name}({ROW}, '?', {more}array('billing', 'technical', 'sales')) FROM people p ORDER BY id")
        assert sql(f"SELECT {name}_described({ROW}, '?', {more}{teams}) FROM people p ORDER BY id") == want and None not in want
    assert sql("SELECT judge_choice_described('1', '?', NULL)") == [None]
    assert sql("SELECT judge_eval_described('1', 'is it 1')") == sql("SELECT judge_eval('1', 'is it 1')")
    with pytest.raises(Exception, match="at least one option"):
        sql("SELECT judge_choice_described('1', '?', CAST(map() AS MAP<STRING, STRING>))")


def test_ask_with_a_question_set_per_row(sql, people):
    p, one = row_payload(people), '{"a": {"type": "noul", "question": "paints murals"}, "b": {"type": "Choice", "question": "?", "options": ["x", "y"]}}'
    two = '{"c": {"type": "score", "question": "how?", "levels": ["l", "m", "h"]}}'
    texts = f"CASE id WHEN 1 THEN '{one}' WHEN 2 THEN '{two}' END"
    got = sql(f"SELECT judge_ask({ROW}, {texts}) FROM people p ORDER BY id")
    want = [people.where(f"id = {i}").select(J.ask_json(p, t)).first()[0] for i, t in ((1, one), (2, two))]
    assert got == [*want, None]
    assert sql(f"SELECT judge_ask(NULL, '{two}')") == [None] and sql("SELECT judge_ask('1', NULL)") == [None]
    for text, message in (("no json", "read as JSON"), ('{"q": {"type": "noul", "question": "?", "x": 1}}', "has no field"), ("{}", "under each name")):
        with pytest.raises(Exception, match=message):
            sql(f"SELECT judge_ask('1', '{text}')")
    assert sql(f"SELECT count(*) FROM people p WHERE get_json_object(judge_ask({ROW}, '{one}'), '$.a.noul') > 0.5") == [1]
