"""The judging functions over whole tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.functions import judging as J
from rowjudge.functions.answers import text_field
from rowjudge.functions.payload import row_payload, value_payload
from rowjudge.functions.sql import register
from rowjudge.judges.rule import RuleJudge
from rowjudge.plans import patterns
from rowjudge.plans.run import judge_rows
from rowjudge.queries.registry import PROMPT_SQL, intent_sql, noul_sql, payload_sql, pick_sql, query
from rowjudge.sources.tables import table

# No text of the test tables holds the last word of the malicious question, so the rule judge
# is told another one to look for.
ON_ERROR = RuleJudge({"malicious": "error"})
ON_AT = RuleJudge({"malicious": "@"})

PROMPT_PAYLOAD = payload_sql(PROMPT_SQL)
TEXT_PAYLOAD = payload_sql("text")
INTENT_LABEL = f"CASE WHEN p >= 0.5 THEN 'malicious' ELSE intent END"


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as the table of AI prompts."""
    events = table(spark, sf, "events")
    return events.select("event_id", "user_id", "ts",
                         F.concat(F.lit("please "), "event_type", F.lit(" "), "props").alias("user_prompt"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` with its text as the payload."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", "lang", "source", "text", value_payload(docs, "text").alias("payload"))


_CLASSIFIED = f"""
  SELECT *, {intent_sql("payload")} AS intent, {noul_sql("payload", "error")} AS p
  FROM (SELECT *, {payload_sql("user_prompt")} AS payload FROM prompts)"""


@query(f"""
WITH prompts AS (SELECT DISTINCT {PROMPT_SQL} AS user_prompt FROM events WHERE {PROMPT_SQL} IS NOT NULL)
SELECT intent, count(*) AS prompts, count(*) FILTER (p >= 0.5) AS malicious FROM ({_CLASSIFIED}) GROUP BY intent""")
def prompt_intent_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.prompt_breakdown(prompts(spark, sf), "user_prompt", judge=ON_ERROR)


@query(f"""
WITH prompts AS (SELECT DISTINCT user_id, {PROMPT_SQL} AS user_prompt FROM events WHERE {PROMPT_SQL} IS NOT NULL)
SELECT user_id, intent, count(*) AS prompts, count(*) FILTER (p >= 0.5) AS malicious
FROM ({_CLASSIFIED}) GROUP BY user_id, intent""")
def prompt_intent_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.prompt_breakdown(prompts(spark, sf), "user_prompt", by=["user_id"], judge=ON_ERROR)


@query(f"""
WITH c AS (SELECT conv_id, turn, {TEXT_PAYLOAD} AS payload FROM conversations WHERE role = 'user'),
i AS (SELECT conv_id, turn, {intent_sql("payload")} AS intent, {noul_sql("payload", "@")} AS p FROM c)
SELECT conv_id, turn, intent, 1.0::DOUBLE AS intent_confidence,
  CASE WHEN intent = 'work_related' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_work_related,
  CASE WHEN intent = 'personal' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_personal,
  CASE WHEN intent = 'other' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_other,
  p AS malicious_probability FROM i""")
def prompt_intent_flat(spark: SparkSession, sf: str) -> DataFrame:
    user = table(spark, sf, "conversations").where(F.col("role") == "user")
    judged = J.with_prompt_intent(user, "text", judge=ON_AT)
    share = F.col("r.intent_probabilities")
    return judged.select(
        "conv_id", "turn", "r.intent", "r.intent_confidence",
        *[share[label].alias(f"p_{label}") for label in ("work_related", "personal", "other")],
        "r.malicious_probability")


@query(f"""
WITH prompts AS (SELECT user_id, {PROMPT_SQL} AS user_prompt FROM events)
SELECT user_id, {INTENT_LABEL} AS label, count(*) AS n_rows, count(DISTINCT user_prompt) AS prompts
FROM ({_CLASSIFIED}) GROUP BY ALL""")
def prompt_intent_joinback(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.breakdown_of_rows(prompts(spark, sf), "user_prompt", by=["user_id"], judge=ON_ERROR)


@query(f"""
WITH d AS (SELECT doc_id, CASE WHEN lang = 'de' THEN NULL ELSE text END AS text FROM documents),
q AS (SELECT doc_id, {TEXT_PAYLOAD} AS payload, text IS NULL AS hidden FROM d)
SELECT doc_id, CASE WHEN hidden THEN NULL ELSE {intent_sql("payload")} END AS intent,
  CASE WHEN hidden THEN NULL ELSE {noul_sql("payload", "@")} END AS malicious_probability, hidden AS is_null FROM q""")
def prompt_intent_nulls(spark: SparkSession, sf: str) -> DataFrame:
    shown = patterns.suppress(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text",
                              F.col("lang") == "de")
    judged = J.with_prompt_intent(shown, "text", judge=ON_AT)
    return judged.select("doc_id", "r.intent", "r.malicious_probability", F.col("r").isNull().alias("is_null"))


@query(f"""
SELECT doc_id, {noul_sql(TEXT_PAYLOAD, "license")} >= 0.5 AS about_license FROM documents""")
def judge_bool(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", J.holds(F.col("payload"), "the text holds a license").alias("about_license"))


@query(f"""
WITH q AS (SELECT doc_id, lang, {noul_sql(TEXT_PAYLOAD, "the")} AS p FROM documents)
SELECT doc_id, p >= 0.95 AS above_constant,
  p >= coalesce(CASE lang WHEN 'en' THEN 0.05::DOUBLE WHEN 'fr' THEN 0.95::DOUBLE END, 0.5::DOUBLE) AS above_own
FROM q""")
def judge_threshold(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    payload, condition = F.col("payload"), "one word of the text is the"
    own = F.when(F.col("lang") == "en", 0.05).when(F.col("lang") == "fr", 0.95)
    return docs.select("doc_id", J.holds(payload, condition, 0.95).alias("above_constant"),
                       J.holds(payload, condition, own).alias("above_own"))


@query(f"""
SELECT doc_id, {noul_sql(TEXT_PAYLOAD, "license")} AS probability FROM documents""")
def judge_prob(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", J.probability(F.col("payload"), "the text holds a license").alias("probability"))


LEVELS = ["casual", "plain", "formal"]
DEPOTS = ["harbour", "rail", "road"]
TOLD_DEPOTS = {"harbour": "goods that come by ship", "rail": "goods that come by train", "road": None}
CUSTOMER_SQL = """concat('{"c_custkey":', c_custkey, ',"c_name":', to_json(c_name),
  ',"c_nationkey":', c_nationkey, ',"c_mktsegment":', to_json(c_mktsegment), '}')"""
CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def customers(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer")
    return people.select("c_custkey", "c_mktsegment", row_payload(people, CUSTOMER_COLUMNS).alias("payload"))


@query(f"""
SELECT doc_id, CAST(length({TEXT_PAYLOAD}) % 3 AS DOUBLE) AS score FROM documents""")
def judge_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", J.score(F.col("payload"), "how formal is the text?", LEVELS).alias("score"))


@query(f"""
SELECT c_custkey, CAST(length({CUSTOMER_SQL}) % 4 AS DOUBLE) / 3 AS formality,
  CAST(0 AS DOUBLE) AS one_level FROM customer""")
def judge_score_norm(spark: SparkSession, sf: str) -> DataFrame:
    people = customers(spark, sf)
    payload = F.col("payload")
    return people.select("c_custkey",
                         J.score_norm(payload, "how formal?", [*LEVELS, "solemn"]).alias("formality"),
                         J.score_norm(payload, "how formal?", ["any"]).alias("one_level"))


PART_SQL = "concat('{\"p_name\":', to_json(p_name), ',\"p_size\":', p_size, '}')"


@query(f"""
SELECT p_partkey, {pick_sql(PART_SQL, ["tools", "toys"])} AS shelf FROM part""")
def judge_choice(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    payload = row_payload(parts, ["p_name", "p_size"])
    return parts.select("p_partkey", J.choice(payload, "on which shelf?", ["tools", "toys"]).alias("shelf"))


@query(f"""
SELECT c_custkey, {pick_sql(CUSTOMER_SQL, DEPOTS)} AS depot, {pick_sql(CUSTOMER_SQL, DEPOTS)} AS depot_by_column
FROM customer""")
def judge_choice_described(spark: SparkSession, sf: str) -> DataFrame:
    people = customers(spark, sf).withColumn("depots", F.array(*[F.lit(t) for t in DEPOTS]))
    question = "which depot serves the customer?"
    return people.select("c_custkey", J.choice(F.col("payload"), question, TOLD_DEPOTS).alias("depot"),
                         J.choice(F.col("payload"), question, F.col("depots")).alias("depot_by_column"))


@query(f"""
SELECT c_custkey, depot, depot AS depot_in_sql, depot AS depot_in_run, {len(TOLD_DEPOTS)}::INTEGER AS told
FROM (SELECT c_custkey, {pick_sql(CUSTOMER_SQL, DEPOTS)} AS depot FROM customer)""")
def judge_choice_map(spark: SparkSession, sf: str) -> DataFrame:
    """Labels and descriptions that come as a MAP column, some of them NULL: as a column, in SQL, and in a run that makes each row's
    question from them."""
    told = F.create_map(*[F.lit(x) for pair in TOLD_DEPOTS.items() for x in pair])
    people = customers(spark, sf).withColumn("depots", told)
    question = "which depot serves the customer?"
    register(spark, generic=True)
    people = people.withColumn("in_sql", F.expr(f"judge_choice_described(payload, '{question}', depots)"))
    run = judge_rows(people, F.col("payload"), J.question_text("choice", question, F.col("depots")),
                     fields={"in_run": lambda answers: text_field(answers[0], "choice")})
    return run.rows.select("c_custkey", J.choice(F.col("payload"), question, F.col("depots")).alias("depot"),
                           F.col("in_sql").alias("depot_in_sql"), F.col("in_run").alias("depot_in_run"), F.size("depots").alias("told"))


ASKED = ('{"p": {"type": "noul", "question": "has the word la"}, "s": {"type": "choice", "question": "how long?", "options": '
         '["short", "long"]}, "n": {"type": "score", "question": "how clear?", "levels": ["low", "mid", "high"]}}')
ASKED_ONE = '{"p": {"type": "noul", "question": "has the word the"}}'


@query(f"""
SELECT conv_id, turn, CASE role WHEN 'user' THEN {noul_sql("payload", "la")} WHEN 'assistant' THEN {noul_sql("payload", "the")} END AS p,
  CASE WHEN role = 'user' THEN {pick_sql("payload", ["short", "long"])} END AS s,
  CASE WHEN role = 'user' THEN CAST(length(payload) % 3 AS DOUBLE) END AS n,
  CASE role WHEN 'user' THEN 3 WHEN 'assistant' THEN 1 END::INTEGER AS answers
FROM (SELECT *, {TEXT_PAYLOAD} AS payload FROM conversations)""")
def sql_ask(spark: SparkSession, sf: str) -> DataFrame:
    """``judge_ask(payload, questions)`` in SQL, with a question set per row; a row without one is not asked."""
    register(spark, generic=True)
    table(spark, sf, "conversations").createOrReplaceTempView("_sql_ask_turns")
    sets = f"CASE role WHEN 'user' THEN '{ASKED}' WHEN 'assistant' THEN '{ASKED_ONE}' END"
    return spark.sql(f"""
        SELECT conv_id, turn, CAST(get_json_object(a, '$.p.noul') AS DOUBLE) AS p, get_json_object(a, '$.s.choice') AS s,
          CAST(get_json_object(a, '$.n.score') AS DOUBLE) AS n, size(json_object_keys(a)) AS answers
        FROM (SELECT conv_id, turn, judge_ask(text_payload(text), {sets}) AS a FROM _sql_ask_turns)""")


@query("""
SELECT c_custkey, 1.0::DOUBLE AS choice_confidence, 1.0::DOUBLE AS score_confidence,
  CAST(NULL AS DOUBLE) AS noul_confidence FROM customer""")
def judge_confidence(spark: SparkSession, sf: str) -> DataFrame:
    people = customers(spark, sf)
    payload, question = F.col("payload"), "which depot serves the customer?"
    return people.select("c_custkey",
                         J.confidence(payload, question, "choice", TOLD_DEPOTS).alias("choice_confidence"),
                         J.confidence(payload, "how formal?", "SCORE", LEVELS).alias("score_confidence"),
                         J.confidence(payload, question, "noul", None).alias("noul_confidence"))


@query(f"""
SELECT doc_id, CASE WHEN p > 0.5 THEN '{{"type":"noul","noul":0.9}}' ELSE '{{"type":"noul","noul":0.1}}' END AS answer
FROM (SELECT doc_id, {noul_sql(TEXT_PAYLOAD, "license")} AS p FROM documents)""")
def judge_eval_noul(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", J.evaluate(F.col("payload"), "the text holds a license").alias("answer"))


@query(f"""
SELECT doc_id, 'score' AS type, CAST(lvl AS DOUBLE) AS score, ['casual', 'plain', 'formal'][lvl + 1] AS level,
  1.0::DOUBLE AS p_level, 1.0::DOUBLE AS confidence
FROM (SELECT doc_id, CAST(length({TEXT_PAYLOAD}) % 3 AS INTEGER) AS lvl FROM documents)""")
def judge_eval_score(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    answers = docs.select("doc_id", J.evaluate(F.col("payload"), "how formal?", "Score", LEVELS).alias("a"))
    parsed = answers.select("doc_id", F.from_json("a", """type string, score double, legend map<string,string>,
        probabilities map<string,double>, confidence double""").alias("a"))
    at = F.col("a.score").cast("int").cast("string")
    return parsed.select("doc_id", "a.type", "a.score", F.col("a.legend")[at].alias("level"),
                         F.col("a.probabilities")[at].alias("p_level"), "a.confidence")


@query(f"""
SELECT c_custkey, depot AS choice, 'harbour,rail,road' AS labels,
  CASE WHEN depot = 'harbour' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_harbour
FROM (SELECT c_custkey, {pick_sql(CUSTOMER_SQL, DEPOTS)} AS depot FROM customer)""")
def judge_eval_choice(spark: SparkSession, sf: str) -> DataFrame:
    people = customers(spark, sf)
    answers = people.select("c_custkey", J.evaluate(F.col("payload"), "which depot?", "choice", TOLD_DEPOTS).alias("a"))
    shares = F.get_json_object("a", "$.probabilities")
    return answers.select("c_custkey", F.get_json_object("a", "$.choice").alias("choice"),
                          F.array_join(F.json_object_keys(shares), ",").alias("labels"),
                          F.get_json_object("a", "$.probabilities.harbour").cast("double").alias("p_harbour"))


QUESTIONS = json.dumps({
    "depot": {"type": "choice", "question": "which depot serves the customer?", "options": {**TOLD_DEPOTS, "road": "all other goods"}},
    "machines": {"type": "noul", "question": "the customer trades in machinery",
                 "criteria": {"true": "machines or their parts", "false": "no machines"}},
    "formality": {"type": "score", "question": "how formal is the name?", "levels": LEVELS}})


@query(f"""
WITH q AS (SELECT c_custkey, {CUSTOMER_SQL} AS payload, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, n_name, {pick_sql("payload", DEPOTS)} AS depot, {noul_sql("payload", "machinery")} AS machines,
  CAST(length(payload) % 3 AS DOUBLE) AS formality, 'depot,machines,formality' AS keys FROM q""")
def ask_multi(spark: SparkSession, sf: str) -> DataFrame:
    people, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    asked = (people.join(nation, people.c_nationkey == nation.n_nationkey)
             .select("c_custkey", "n_name", row_payload(people, CUSTOMER_COLUMNS).alias("payload")))
    judged = asked.select("c_custkey", "n_name", J.ask(F.col("payload"), QUESTIONS).alias("a"))
    return judged.select("c_custkey", "n_name", F.col("a.depot.choice").alias("depot"),
                         F.col("a.machines.noul").alias("machines"), F.col("a.formality.score").alias("formality"),
                         F.array_join(F.json_object_keys(F.to_json("a")), ",").alias("keys"))


ORDER_SQL = """concat('{"o_orderkey":', o_orderkey, ',"o_orderstatus":', to_json(o_orderstatus),
  ',"o_orderpriority":', to_json(o_orderpriority), '}')"""


@query(f"""
WITH q AS (SELECT o_orderkey, o_orderstatus, {ORDER_SQL} AS payload FROM orders)
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN {noul_sql("payload", "urgent")}
  WHEN 'O' THEN {noul_sql("payload", "high")} END AS probability FROM q""")
def per_row_question(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    asked = orders.select("o_orderkey", "o_orderstatus",
                          row_payload(orders, ["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("payload"))
    question = (F.when(F.col("o_orderstatus") == "F", "the order is urgent")
                .when(F.col("o_orderstatus") == "O", "the priority is high"))
    return asked.select("o_orderkey", J.probability(F.col("payload"), question).alias("probability"))


@query(f"""
SELECT doc_id, probability FROM (SELECT doc_id, {noul_sql(TEXT_PAYLOAD, "license")} AS probability FROM documents)
ORDER BY probability DESC, doc_id LIMIT 20""")
def topk_prob(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    judged = docs.select("doc_id", J.probability(F.col("payload"), "the text holds a license").alias("probability"))
    return patterns.top_by_probability(judged, "probability", "doc_id", 20)


@query(f"""
SELECT doc_id, source FROM documents WHERE lang = 'en' AND {noul_sql(TEXT_PAYLOAD, "the")} >= 0.5""")
def semantic_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    english = docs.where(F.col("lang") == "en")
    return english.where(J.holds(value_payload(docs, "text"), "one word of the text is the")).select("doc_id", "source")


@query(f"""
SELECT {pick_sql(TEXT_PAYLOAD, DEPOTS)} AS depot, lang, count(*) AS n_docs FROM documents GROUP BY ALL""")
def routing_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    depot = J.choice(F.col("payload"), "which depot serves the customer?", TOLD_DEPOTS)
    return docs.groupBy(depot.alias("depot"), "lang").agg(F.count(F.lit(1)).alias("n_docs"))


@query(f"""
SELECT contains(text, '@') AS flagged_in_text, max({noul_sql(TEXT_PAYLOAD, "@")}) AS highest, count(*) AS n_rows
FROM conversations GROUP BY ALL""")
def flag_vs_answer(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    p = J.intent_of_payload(value_payload(turns, "text"), judge=ON_AT)["malicious_probability"]
    return turns.groupBy(F.contains("text", F.lit("@")).alias("flagged_in_text")).agg(
        F.max(p).alias("highest"), F.count(F.lit(1)).alias("n_rows"))


@query(f"""
SELECT lang, bool_and({pick_sql(TEXT_PAYLOAD, DEPOTS)} IN ('harbour', 'rail', 'road')) AS labels_valid,
  bool_and(length({TEXT_PAYLOAD}) % 3 BETWEEN 0 AND 2) AS scores_valid FROM documents GROUP BY lang""")
def all_labels_valid(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    depot = J.choice(F.col("payload"), "which depot?", DEPOTS)
    level = J.score(F.col("payload"), "how formal?", LEVELS)
    return docs.groupBy("lang").agg(F.every(depot.isin(DEPOTS)).alias("labels_valid"),
                                    F.every(level.between(0, 2)).alias("scores_valid"))


@query(f"""
WITH prompts AS (SELECT DISTINCT {PROMPT_SQL} AS user_prompt FROM events WHERE {PROMPT_SQL} IS NOT NULL),
n AS (SELECT count(*) AS population FROM prompts),
s AS (SELECT {INTENT_LABEL} AS label FROM ({_CLASSIFIED} ORDER BY md5(user_prompt), user_prompt LIMIT 100)),
g AS (SELECT label, count(*) AS sampled, any_value(population) AS population,
        count(*)::DOUBLE / least(100, any_value(population)) AS share FROM s, n GROUP BY label)
SELECT label, sampled, population, share,
  round(1.96 * sqrt(share * (1 - share) / least(100, population)), 6) AS half_width,
  CAST(round(share * population) AS BIGINT) AS estimated_prompts FROM g""")
def sample_estimate(spark: SparkSession, sf: str) -> DataFrame:
    estimate = patterns.sample_estimate(prompts(spark, sf), "user_prompt", 100, judge=ON_ERROR)
    return estimate.withColumn("half_width", F.round("half_width", 6))


_LABELLED_SQL = f"""
  SELECT toxic = 1 AS expected, payload, ceil_tokens AS tokens FROM (
    SELECT toxic, payload, {{tokens}} AS ceil_tokens FROM (
      SELECT toxic, {TEXT_PAYLOAD} AS payload FROM documents JOIN labels USING (doc_id)))"""

TOKENS_SQL = r"""CAST(((length(regexp_replace(payload, '[^\x00-\x7F]', '', 'g')) + 2) // 3)
  + length(regexp_replace(payload, '[^\x{80}-\x{7FF}]', '', 'g'))
  + 2 * length(regexp_replace(payload, '[^\x{800}-\x{10FFFF}]', '', 'g')) AS BIGINT)"""

_QUALITY_SQL = """count(*) AS n_rows, count(*) FILTER ((p >= 0.5) = expected)::DOUBLE / count(*) AS accuracy,
  count(*) FILTER (expected) AS positives, count(*) FILTER (p >= 0.5 AND expected) AS caught,
  count(*) FILTER (p >= 0.5 AND NOT expected) AS false_alarms, min(p) FILTER (expected) AS lowest_positive,
  max(p) FILTER (NOT expected) AS highest_negative, sum(tokens)::DOUBLE / count(*) AS tokens_per_row"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "payload")
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", (F.col("toxic") == 1).alias("expected"), "payload")


@query(f"""
SELECT {_QUALITY_SQL} FROM (SELECT expected, tokens, {noul_sql("payload", "license")} AS p
  FROM ({_LABELLED_SQL.format(tokens=TOKENS_SQL)}))""")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled(spark, sf)
    judged = patterns.judged_by_each(rows, "payload", {"rules": J.probability(F.col("payload"), "about a license")})
    return patterns.quality_report(judged)


@query(f"""
SELECT judge, {_QUALITY_SQL} FROM (
  SELECT 'license' AS judge, expected, tokens, {noul_sql("payload", "license")} AS p FROM labelled
  UNION ALL SELECT 'mail', expected, tokens, {noul_sql("payload", "@")} FROM labelled
  UNION ALL SELECT 'word', expected, tokens, {noul_sql("payload", "the")} FROM labelled) GROUP BY judge
""".replace("SELECT judge,", f"WITH labelled AS ({_LABELLED_SQL.format(tokens=TOKENS_SQL)}) SELECT judge,", 1))
def judge_comparison(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    judges = {"license": J.probability(payload, "?", needle="license"),
              "mail": J.probability(payload, "?", needle="@"), "word": J.probability(payload, "?", needle="the")}
    return patterns.quality_report(patterns.judged_by_each(labelled(spark, sf), "payload", judges), by=["judge"])


@query(f"""
WITH q AS (SELECT o_orderkey, o_orderstatus, {ORDER_SQL} AS payload FROM orders)
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN concat('{{"urgent":{{"type":"noul","noul":', {noul_sql("payload", "urgent")}, '}}}}')
  WHEN 'O' THEN concat('{{"high":{{"type":"noul","noul":', {noul_sql("payload", "high")}, '}},"low":{{"type":"noul","noul":',
    {noul_sql("payload", "low")}, '}}}}') END AS answers FROM q""")
def ask_per_row_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Which questions are asked depends on the row; rows without any are not judged."""
    orders = table(spark, sf, "orders")
    one = '{"urgent": {"type": "noul", "question": "the order is urgent"}}'
    two = '{"high": {"type": "noul", "question": "it is high"}, "low": {"type": "noul", "question": "it is low"}}'
    questions = F.when(F.col("o_orderstatus") == "F", one).when(F.col("o_orderstatus") == "O", two)
    payload = row_payload(orders, ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return J.with_asked(orders, payload, questions).select("o_orderkey", "answers")


@query(f"""
WITH q AS (SELECT c_custkey, c_mktsegment, {CUSTOMER_SQL} AS payload FROM customer)
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'noul' WHEN c_mktsegment = 'MACHINERY' THEN 'choice'
    WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE 'score' END AS type,
  CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN NULL ELSE 1.0::DOUBLE END AS confidence FROM q""")
def judge_eval_kind_column(spark: SparkSession, sf: str) -> DataFrame:
    people, segment = customers(spark, sf), F.col("c_mktsegment")
    kind = (F.when(segment == "BUILDING", "NOUL").when(segment == "MACHINERY", "Choice")
            .when(segment != "FURNITURE", "score"))
    payload = F.col("payload")
    return people.select("c_custkey", F.get_json_object(J.evaluate(payload, "which?", kind, LEVELS), "$.type").alias("type"),
                         J.confidence(payload, "which?", kind, LEVELS).alias("confidence"))


@query(f"""
WITH q AS (SELECT doc_id, lang, {TEXT_PAYLOAD} AS payload FROM documents)
SELECT doc_id, {noul_sql("payload", "license")} AS probability, {noul_sql("payload", "license")} >= 0.5 AS holds,
  {pick_sql("payload", DEPOTS)} AS depot, CAST(length(payload) % 3 AS DOUBLE) / 2 AS formality,
  {pick_sql("payload", ["work_related", "personal", "other"])} AS intent, 0.1::DOUBLE AS malicious_probability
FROM q""")
def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """The same functions, called from SQL."""
    register(spark, generic=True)
    table(spark, sf, "documents").createOrReplaceTempView("rowjudge_documents")
    return spark.sql("""
        SELECT doc_id, judge_prob(payload, 'the text holds a license') AS probability,
          judge(payload, 'the text holds a license') AS holds,
          judge_choice(payload, 'which depot?', array('harbour', 'rail', 'road')) AS depot,
          judge_score_norm(payload, 'how formal?', array('casual', 'plain', 'formal')) AS formality,
          r.intent, r.malicious_probability
        FROM (SELECT doc_id, text_payload(text) AS payload, prompt_intent(text) AS r FROM rowjudge_documents)""")
