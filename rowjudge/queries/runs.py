"""Whole runs, and the books kept over them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowjudge.config import CONF_PREFIX
from rowjudge.functions import answers as A
from rowjudge.functions.judging import with_prompt_intent
from rowjudge.functions.payload import row_payload, value_payload
from rowjudge.judges.callable import CallableJudge, JudgeError
from rowjudge.operators.dedupe import with_entry_key
from rowjudge.operators.guards import CapExceeded
from rowjudge.operators.requests import request_body
from rowjudge.plans import accounting
from rowjudge.plans.run import judge_rows
from rowjudge.queries.judging import ON_AT, TEXT_PAYLOAD, documents, prompts
from rowjudge.queries.registry import PROMPT_SQL, intent_sql, noul_sql, payload_sql, query
from rowjudge.queries.requests import CFG, key_sql
from rowjudge.questions import ITEM_SLOT, PROMPT_INTENT
from rowjudge.sources import files
from rowjudge.sources.answer_store import AnswerStore
from rowjudge.sources.ledger import Ledger
from rowjudge.sources.tables import table

# -- the books: three runs over the prompts of ``events`` -------------------------------------

FIRST_DAY, DAYS = "2024-01-01", 10
HIDDEN, HEAVY = "purchase", '{"k": 7}'
BOOKS = CFG.with_(concurrency=4, batch_size=4)
_BOOKS: dict[tuple[str, str], str] = {}


def picky_reply(request: str, timeout: float) -> str:
    """The rules as a batch function that takes prompts with HEAVY alone only."""
    items = json.loads(request)["state"]["items"]
    if len(items) > 1 and any(text.endswith(HEAVY) for text in items.values()):
        raise JudgeError("one of several is too heavy", 413)
    return json.dumps(answers_to(items, request))


def books(spark: SparkSession, sf: str) -> tuple[AnswerStore, Ledger]:
    """What three runs wrote, one for every ten days of prompts: each customer is a scope, mornings and afternoons are two queries
    that share a run, suppressed prompts are NULL, and the judge refuses some batches until they are small enough. A session
    runs them once for a table."""
    known = (spark.sparkContext.applicationId, sf)
    folder = _BOOKS.get(known)
    if folder is None or not files.exists(spark, f"{folder}/ledger"):
        folder = f"{files.scratch_dir(spark)}/books-{uuid.uuid4().hex}"
        store, ledger = AnswerStore(spark, f"{folder}/store"), Ledger(spark, f"{folder}/ledger")
        rows = prompts(spark, sf)
        shown = F.when(~F.col("user_prompt").startswith(f"please {HIDDEN} "), F.col("user_prompt"))
        rows = rows.withColumn("user_prompt", shown).withColumn(
            "run", F.floor(F.date_diff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date")) / DAYS))
        for number in range(3):
            one = rows.where(F.col("run") == number)
            judge_rows(one, value_payload(one, "user_prompt"), PROMPT_INTENT, CallableJudge(picky_reply), cfg=BOOKS, store=store,
                       ledger=ledger, scope=F.col("user_id"), query_id=F.when(F.hour("ts") < 12, "am").otherwise("pm"))
        _BOOKS[known] = folder
    return AnswerStore(spark, f"{folder}/store"), Ledger(spark, f"{folder}/ledger")


# Length of a request: a fixed part, and per item its payload, number, templates and commas.
_EMPTY = len(request_body(CFG.model, PROMPT_INTENT, []))
_TEMPLATES = "".join(PROMPT_INTENT.item_templates)
_DIGITS = 1 + _TEMPLATES.count(ITEM_SLOT)
_ITEM = len('"":') + len(_TEMPLATES) - _TEMPLATES.count(ITEM_SLOT)
_COMMAS = 1 + len(PROMPT_INTENT.questions)


def _level_sql(level: int, size: int) -> str:
    """One packing of what is left: batches of ``size``, refused or not, and what that leaves."""
    return f"""
  p{level} AS (SELECT *, (row_number() OVER (PARTITION BY run, scope ORDER BY entry_key) - 1) AS pos FROM m{level}),
  b{level} AS (SELECT run, scope, pos // {size} AS no, count(*) AS n_items, bool_or(heavy) AND count(*) > 1 AS refused,
      ({_EMPTY} - 2 + sum({_ITEM} + {_COMMAS} + {_DIGITS} * length(CAST(pos % {size} + 1 AS VARCHAR)) + length(payload))) // 4 AS tokens
    FROM p{level} GROUP BY run, scope, pos // {size}),
  m{level + 1} AS (SELECT p.run, p.scope, p.q, p.entry_key, p.payload, p.heavy FROM p{level} p
    JOIN b{level} b ON p.run = b.run AND p.scope = b.scope AND p.pos // {size} = b.no WHERE refused)"""


_SIZES = (4, 2, 1)
_BOOKS_SQL = f"""
  e AS (SELECT CAST((CAST(ts AS DATE) - DATE '{FIRST_DAY}') // {DAYS} + 1 AS BIGINT) AS run, CAST(user_id AS VARCHAR) AS scope,
      CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS q, props = '{HEAVY}' AS heavy,
      CASE WHEN event_type <> '{HIDDEN}' THEN {payload_sql(PROMPT_SQL)} END AS payload FROM events),
  r AS (SELECT run, q, scope, payload, bool_or(heavy) AS heavy, count(*) AS n,
      CASE WHEN payload IS NOT NULL THEN {key_sql("scope", "payload")} END AS entry_key FROM e GROUP BY run, q, scope, payload),
  w AS (SELECT *, CASE WHEN payload IS NULL THEN 'null' WHEN run > min(run) OVER (PARTITION BY entry_key) THEN 'hit' ELSE 'miss' END AS fate,
      q = min(q) OVER (PARTITION BY run, entry_key) AS owner FROM r),
  m0 AS (SELECT run, scope, q, entry_key, payload, heavy FROM w WHERE fate = 'miss' AND owner),
  {",".join(_level_sql(level, size) for level, size in enumerate(_SIZES))},
  b AS ({" UNION ALL ".join(f"SELECT * FROM b{level}" for level in range(len(_SIZES)))}),
  c AS (SELECT run, count(*) FILTER (payload IS NOT NULL) AS keys, CAST(sum(n) AS BIGINT) AS rows_in,
      CAST(coalesce(sum(n) FILTER (fate = 'null'), 0) AS BIGINT) AS rows_null,
      CAST(coalesce(sum(n - 1) FILTER (fate = 'miss'), 0) AS BIGINT) AS rows_deduped,
      CAST(coalesce(sum(n) FILTER (fate = 'hit'), 0) AS BIGINT) AS cache_hits,
      count(*) FILTER (fate = 'miss' AND NOT owner) AS shared_in_flight, count(*) FILTER (fate = 'miss' AND owner) AS rows_sent
    FROM w GROUP BY run),
  g AS (SELECT run, count(*) AS reclaimed FROM m1 GROUP BY run),
  t AS (SELECT run, count(*) FILTER (NOT refused) AS requests, count(*) FILTER (refused) AS retries,
      CAST(coalesce(sum(tokens) FILTER (NOT refused), 0) AS BIGINT) AS input_tokens,
      CAST(coalesce(sum(2 * n_items) FILTER (NOT refused), 0) AS BIGINT) AS output_tokens FROM b GROUP BY run),
  runs AS (SELECT c.*, coalesce(reclaimed, 0) AS reclaimed, requests, retries, input_tokens, output_tokens,
      input_tokens * 0.042::DOUBLE / 1000000.0::DOUBLE AS estimated_cost_usd FROM c JOIN t USING (run) LEFT JOIN g USING (run))"""
_REPORT = ("seq", *accounting.ROW_COUNTERS, *accounting.SPEND_COUNTERS, "estimated_cost_usd")


@query(f"""
WITH {_BOOKS_SQL}
SELECT run AS seq, rows_in, rows_null, rows_deduped, cache_hits, shared_in_flight, rows_sent, reclaimed, requests, retries, input_tokens,
  output_tokens, estimated_cost_usd FROM runs""")
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    _, ledger = books(spark, sf)
    return accounting.run_report(ledger.runs(), ledger.batches()).select(*_REPORT)


@query(f"""
WITH {_BOOKS_SQL}
SELECT run AS seq, rows_in, rows_null, rows_deduped, cache_hits, shared_in_flight, rows_sent, reclaimed, requests, retries, input_tokens,
  output_tokens, estimated_cost_usd FROM runs WHERE run = (SELECT max(run) FROM runs)""")
def last_run_report(spark: SparkSession, sf: str) -> DataFrame:
    _, ledger = books(spark, sf)
    return accounting.last_report(ledger.runs(), ledger.batches(), spark.sparkContext.applicationId).select(*_REPORT)


@query(f"""
WITH {_BOOKS_SQL}
SELECT {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("cache_hits", "shared_in_flight", "reclaimed", *accounting.SPEND_COUNTERS))},
  CAST(sum(input_tokens) AS BIGINT) * 0.042::DOUBLE / 1000000.0::DOUBLE AS estimated_cost_usd, CAST(sum(rows_sent) AS BIGINT) AS rows_evaluated,
  true AS api_timed, CAST(sum(retries) AS BIGINT) AS errors, (SELECT count(DISTINCT entry_key) FROM w) AS cached_answers FROM runs""")
def engine_stats(spark: SparkSession, sf: str) -> DataFrame:
    store, ledger = books(spark, sf)
    stats = accounting.engine_stats(ledger.runs(), ledger.batches(), store.latest())
    return stats.withColumn("api_timed", F.col("api_ms") > 0).drop("api_ms")


@query(f"""
WITH {_BOOKS_SQL}
SELECT run AS phase, CASE WHEN run > 1 THEN rows_sent END AS rows_evaluated_since, CASE WHEN run > 1 THEN retries END AS retries_since FROM runs""")
def stats_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The counters as they stood after each run (one row per run), and their steps."""
    _, ledger = books(spark, sf)
    runs = accounting.run_report(ledger.runs(), ledger.batches())
    upto = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stood = runs.select(F.col("seq").alias("phase"), F.sum("rows_sent").over(upto).alias("rows_evaluated"), F.sum("retries").over(upto).alias("retries"))
    return accounting.stats_delta(stood, "rows_evaluated").join(accounting.stats_delta(stood, "retries"), "phase")


@query(f"""
WITH {_BOOKS_SQL}
SELECT scope, model, count(*) AS requests, CAST(sum(n_items) AS BIGINT) AS rows_sent, CAST(sum(tokens) AS BIGINT) AS input_tokens,
  CAST(sum(tokens) AS BIGINT) * 0.042::DOUBLE / 1000000.0::DOUBLE AS estimated_cost_usd
FROM (SELECT *, '{CFG.model}' AS model FROM b WHERE NOT refused) GROUP BY ROLLUP (scope, model)""")
def scope_spend_rollup(spark: SparkSession, sf: str) -> DataFrame:
    _, ledger = books(spark, sf)
    return accounting.scope_spend(ledger.batches())


@query(f"""
WITH {_BOOKS_SQL},
  s AS (SELECT run, q, CAST(sum(n) AS BIGINT) AS rows_in, CAST(coalesce(sum(n) FILTER (fate = 'null'), 0) AS BIGINT) AS rows_null,
      CAST(coalesce(sum(n) FILTER (fate = 'hit'), 0) AS BIGINT) AS cache_hits, count(*) FILTER (fate = 'miss' AND owner) AS rows_sent,
      count(*) FILTER (fate = 'miss' AND NOT owner) AS shared_in_flight,
      CAST(coalesce(sum(n - 1) FILTER (fate = 'miss'), 0) AS BIGINT) AS rows_deduped FROM w GROUP BY run, q),
  a AS (SELECT run, q, count(*) AS reclaimed FROM m1 GROUP BY run, q)
SELECT run AS seq, q AS query_id, rows_in, rows_null, cache_hits, rows_sent, shared_in_flight, rows_deduped, coalesce(reclaimed, 0) AS reclaimed
FROM s LEFT JOIN a USING (run, q)""")
def shared_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two queries at a time in one run: what each asked, what it sent, and what the other sent for it."""
    _, ledger = books(spark, sf)
    return ledger.runs().select("seq", "query_id", "rows_in", "rows_null", "cache_hits", "rows_sent", "shared_in_flight", "rows_deduped", "reclaimed")


@query(f"""
WITH {_BOOKS_SQL}
SELECT run AS seq, n_items, CASE WHEN refused THEN 'failed' ELSE 'ok' END AS status, CASE WHEN refused THEN 'one of several is too heavy' END AS error,
  count(*) AS batches FROM b GROUP BY ALL""")
def retry_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """Every batch that was sent, by size: refused ones go again in halves."""
    _, ledger = books(spark, sf)
    runs = ledger.runs().select("run_id", "seq").distinct()
    sent = ledger.batches().join(runs, "run_id")
    return sent.groupBy("seq", F.col("n_items").cast("bigint").alias("n_items"), "status", "error").agg(F.count(F.lit(1)).alias("batches"))


# -- a store through its life ----------------------------------------------------------------

KEPT = 400
_LIFE_SQL = f"""
  d AS (SELECT coalesce(source, '') AS scope, {TEXT_PAYLOAD} AS payload, bool_or(lang = 'en') AS en, min(doc_id) AS low FROM documents
    WHERE text IS NOT NULL GROUP BY 1, 2),
  k AS (SELECT *, {key_sql("scope", "payload")} AS entry_key, scope = (SELECT min(scope) FROM d) AS cleared FROM d),
  l AS (SELECT entry_key, CASE WHEN cleared THEN 'after clearing' WHEN en THEN 'replaced' ELSE 'first' END AS answer,
      CAST(CASE WHEN cleared THEN 3 WHEN en THEN 2 ELSE 1 END AS BIGINT) AS seq, CAST(CASE WHEN cleared THEN 3 ELSE 1 END AS BIGINT) AS age
    FROM k WHERE NOT cleared OR low < 50)"""


@query(f"""
WITH {_LIFE_SQL} SELECT * FROM l QUALIFY row_number() OVER (ORDER BY age DESC, entry_key) <= {KEPT}""")
def store_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Answers for all documents are appended, the English ones replaced, one source cleared and partly answered again, all merged
    and the oldest dropped; then the store is asked for every document."""
    docs = table(spark, sf, "documents").where("text IS NOT NULL")
    keyed = docs.select(F.coalesce("source", F.lit("")).alias("scope"), value_payload(docs, "text").alias("payload"), "lang", "doc_id")
    requests = keyed.groupBy("scope", "payload").agg(F.bool_or(F.col("lang") == "en").alias("en"), F.min("doc_id").alias("low"))
    requests = with_entry_key(requests, CFG.model, F.lit(PROMPT_INTENT.set_key)).drop("payload")
    folder = f"{files.scratch_dir(spark)}/life-{uuid.uuid4().hex}"
    requests.write.parquet(f"{folder}/requests")
    requests = spark.read.parquet(f"{folder}/requests")
    store = AnswerStore(spark, f"{folder}/store")
    cleared = requests.agg(F.min("scope")).first()[0]

    def append(rows: DataFrame, answer: str) -> None:
        told = rows.select(F.lit(CFG.model).alias("model"), "scope", F.lit(PROMPT_INTENT.set_key).alias("set_key"), "entry_key",
                           F.array(F.lit(answer)).alias("answers"))
        store.append(told, told.count())

    append(requests, "first")
    append(requests.where("en"), "replaced")
    if cleared is not None:
        store.clear(cleared)
    append(requests.where((F.col("scope") == cleared) & (F.col("low") < 50)), "after clearing")
    store.compact(KEPT)
    return store.lookup(requests).select("entry_key", F.col("answers")[0].alias("answer"), "seq", "age")


# -- whole runs -----------------------------------------------------------------------------

INTENT_FIELDS = {"r": lambda answers: A.prompt_intent_of(answers[0], answers[1])}


@query(f"""
SELECT doc_id, source, intent, 1.0::DOUBLE AS intent_confidence,
  CASE WHEN intent = 'personal' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p_personal, malicious_probability
FROM (SELECT doc_id, source, {intent_sql(TEXT_PAYLOAD)} AS intent, {noul_sql(TEXT_PAYLOAD, "@")} AS malicious_probability
      FROM documents)""")
def judged_run(spark: SparkSession, sf: str) -> DataFrame:
    """A full run: dedupe, pack, judge, keep, join back; every source is its own scope."""
    docs = documents(spark, sf)
    run = judge_rows(docs, F.col("payload"), PROMPT_INTENT, ON_AT, scope=F.col("source"), cfg=CFG, fields=INTENT_FIELDS)
    return run.rows.select("doc_id", "source", "r.intent", "r.intent_confidence",
                           F.col("r.intent_probabilities")["personal"].alias("p_personal"), "r.malicious_probability")


TURN_SQL = """concat('{"role":', to_json(role), ',"text":', to_json(text), '}')"""


@query(f"""
WITH q AS (SELECT conv_id, turn, role, {TURN_SQL} AS payload FROM conversations)
SELECT conv_id, turn, CASE role WHEN 'user' THEN {noul_sql("payload", "la")} WHEN 'assistant' THEN {noul_sql("payload", "the")}
  END AS probability, CASE role WHEN 'user' THEN ['short', 'long'][CAST(length(payload) % 2 AS INTEGER) + 1] END AS size
FROM q""")
def judged_run_per_row_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Question sets that come with the rows; a row without one is not judged."""
    turns = table(spark, sf, "conversations")
    both = '{"p": {"type": "noul", "question": "has the word la"}, "s": {"type": "choice", "question": "how long?", ' \
           '"options": ["short", "long"]}}'
    one = '{"p": {"type": "noul", "question": "has the word the"}}'
    question = F.when(F.col("role") == "user", both).when(F.col("role") == "assistant", one)
    run = judge_rows(turns, row_payload(turns, ["role", "text"]), question, cfg=CFG, fields={
        "probability": lambda answers: A.number_field(answers[0], "noul"),
        "size": lambda answers: A.text_field(F.get(answers, F.lit(1)), "choice")})
    return run.rows.select("conv_id", "turn", "probability", "size")


REFUSED = "license"
FLAKY = CFG.with_(batch_size=5, rows_per_shard=64, max_batch_tokens=1 << 40, concurrency=8)


def rule_reply(request: str, timeout: float) -> str:
    """The rules as a batch function. It refuses a request that holds a refused word."""
    if REFUSED in request.lower():
        raise JudgeError(f"the batch holds a refused word: {REFUSED}", 422)
    return answer_all(request, timeout)


def answer_all(request: str, timeout: float) -> str:
    """The rules as a batch function that refuses nothing."""
    return json.dumps(answers_to(json.loads(request)["state"]["items"], request))


def answers_to(items: dict, request: str) -> dict:
    """The reply of the rules to the items of a request."""
    answers = {}
    for number, text in items.items():
        size = len(json.dumps(text, ensure_ascii=False)) % 3
        answers[f"item_{number}_intent"] = {"type": "choice", "confidence": 1.0,
                                            "choice": ("work_related", "personal", "other")[size],
                                            "probabilities": {"personal": float(size == 1)}}
        answers[f"item_{number}_malicious"] = {"type": "noul", "noul": 0.9 if "@" in text else 0.1}
    return {"answers": answers, "usage": {"input_tokens": len(request) // 4, "output_tokens": len(answers)}}


@query(f"""
WITH d AS (SELECT doc_id, {TEXT_PAYLOAD} AS payload FROM documents)
SELECT doc_id, CASE WHEN NOT contains(lower(payload), '{REFUSED}') THEN {intent_sql("payload")} END AS intent,
  CASE WHEN NOT contains(lower(payload), '{REFUSED}') THEN {noul_sql("payload", "@")} END AS malicious_probability FROM d""")
def retry_pass(spark: SparkSession, sf: str) -> DataFrame:
    """A judge that refuses batches for a word in one row: the paid answers stay, refused batches are split, and just the rows
    with the word are left without an answer."""
    docs = documents(spark, sf)
    run = judge_rows(docs, F.col("payload"), PROMPT_INTENT, CallableJudge(rule_reply), cfg=FLAKY, on_failure="keep",
                     fields=INTENT_FIELDS)
    return run.rows.select("doc_id", "r.intent", "r.malicious_probability")


USER_PAYLOADS_SQL = f"SELECT DISTINCT {TEXT_PAYLOAD} AS payload FROM conversations WHERE role = 'user'"


@query(f"""
WITH n AS (SELECT count(*) AS sent FROM ({USER_PAYLOADS_SQL})), a AS (SELECT count(*) AS rows_in FROM conversations WHERE role = 'user')
SELECT phase::BIGINT AS phase, scope, CASE WHEN fresh THEN sent ELSE 0 END AS rows_sent,
  CASE WHEN fresh THEN 0 ELSE rows_in END AS cache_hits, CASE WHEN fresh THEN rows_in - sent ELSE 0 END AS rows_deduped
FROM n, a, (VALUES (1, '101', true), (2, '101', false), (3, '202', true), (4, '202', true), (5, '101', false))
  t(phase, scope, fresh)""")
def scope_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """One parameterised run for customer 101, the same again, then for customer 202: answers are
    kept, and kept apart. Once 202's are cleared it pays again, 101 does not. The result is read
    from the ledger."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "user")
    folder = f"{files.scratch_dir(spark)}/rerun-{uuid.uuid4().hex}"
    store, ledger = AnswerStore(spark, f"{folder}/store"), Ledger(spark, f"{folder}/ledger")

    def run(scope: str) -> None:
        judge_rows(turns, value_payload(turns, "text"), PROMPT_INTENT, ON_AT, scope=scope, store=store, ledger=ledger,
                   cfg=CFG)

    for scope in ("101", "101", "202"):
        run(scope)
    store.clear(scope="202")
    for scope in ("202", "101"):
        run(scope)
    return ledger.runs().select(F.col("seq").alias("phase"), "scope", "rows_sent", "cache_hits", "rows_deduped")


@query(f"""
WITH n AS (SELECT count(*) AS sent FROM ({USER_PAYLOADS_SQL})), a AS (SELECT count(*) AS rows_in FROM conversations WHERE role = 'user')
SELECT phase::BIGINT AS phase, model, CASE WHEN fresh THEN sent ELSE 0 END AS rows_sent,
  CASE WHEN fresh THEN 0 ELSE rows_in END AS cache_hits, CASE WHEN fresh THEN rows_in - sent ELSE 0 END AS rows_deduped
FROM n, a, (VALUES (1, 'small', true), (2, 'large', true), (3, 'small', false)) t(phase, model, fresh)""")
def model_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same questions to one model, to another, and to the first again: answers of one model never serve the other."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "user")
    folder = f"{files.scratch_dir(spark)}/models-{uuid.uuid4().hex}"
    store, ledger = AnswerStore(spark, f"{folder}/store"), Ledger(spark, f"{folder}/ledger")
    for model in ("small", "large", "small"):
        judge_rows(turns, value_payload(turns, "text"), PROMPT_INTENT, ON_AT, store=store, ledger=ledger, cfg=CFG.with_(model=model))
    return ledger.runs().select(F.col("seq").alias("phase"), "model", "rows_sent", "cache_hits", "rows_deduped")


@query(f"""
WITH n AS (SELECT count(*) AS sent FROM ({USER_PAYLOADS_SQL}))
SELECT sent - 1 AS cap, true AS refused, CAST(NULL AS BIGINT) AS rows_sent FROM n UNION ALL SELECT sent, false, sent FROM n""")
def caps_from_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs under a cap that ``SET`` gives: one row too low, so that the run is refused and no book knows it, then just enough."""
    turns = table(spark, sf, "conversations").where(F.col("role") == "user")
    ledger = Ledger(spark, f"{files.scratch_dir(spark)}/caps-{uuid.uuid4().hex}")
    payload, name, refused = value_payload(turns, "text"), f"{CONF_PREFIX}max_rows_per_run", []
    known = turns.agg(F.count_distinct(payload)).first()[0]
    before = spark.conf.get(name, None)
    try:
        for cap in (known - 1, known):
            spark.conf.set(name, str(cap))
            try:
                judge_rows(turns, payload, PROMPT_INTENT, ON_AT, scope=str(cap), ledger=ledger)
                refused.append((cap, False))
            except CapExceeded:
                refused.append((cap, True))
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    runs = ledger.runs().select(F.col("scope").cast("bigint").alias("cap"), "rows_sent")
    return spark.createDataFrame(refused, "cap bigint, refused boolean").join(runs, "cap", "left")


def careless_reply(request: str, timeout: float) -> str:
    """The rules as a batch function with faults by the length of an item: one answer left out, of the wrong type, or null."""
    items = json.loads(request)["state"]["items"]
    reply = answers_to(items, request)
    for number, text in items.items():
        fault = len(json.dumps(text, ensure_ascii=False)) % 7
        if fault == 0:
            del reply["answers"][f"item_{number}_malicious"]
        elif fault == 1:
            reply["answers"][f"item_{number}_intent"]["choice"] = 1
        elif fault == 2:
            reply["answers"][f"item_{number}_intent"] = None
    return json.dumps(reply)


@query(f"""
WITH d AS (SELECT doc_id, {TEXT_PAYLOAD} AS payload FROM documents)
SELECT doc_id, CASE WHEN length(payload) % 7 > 2 THEN {intent_sql("payload")} END AS intent,
  CASE WHEN length(payload) % 7 > 0 THEN {noul_sql("payload", "@")} END AS malicious_probability FROM d""")
def careless_judge(spark: SparkSession, sf: str) -> DataFrame:
    """Replies that leave an answer out count as failed and are split until just that row is left without answers; answers of the
    wrong type or null are taken as they are, and their fields are NULL, never a default."""
    run = judge_rows(documents(spark, sf), F.col("payload"), PROMPT_INTENT, CallableJudge(careless_reply), cfg=FLAKY, on_failure="keep",
                     fields={"intent": lambda answers: A.text_field(answers[0], "choice"),
                             "malicious_probability": lambda answers: A.number_field(answers[1], "noul")})
    return run.rows.select("doc_id", "intent", "malicious_probability")


@query(f"""
SELECT intent, count(*) AS n_turns, count(DISTINCT conv_id) AS n_conversations,
  bool_and(p BETWEEN 0 AND 1) AS probabilities_valid, max(p) AS highest
FROM (SELECT conv_id, {intent_sql(TEXT_PAYLOAD)} AS intent, {noul_sql(TEXT_PAYLOAD, "@")} AS p FROM conversations) GROUP BY intent""")
def stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """Judge once, keep the table, ask the table."""
    turns = table(spark, sf, "conversations")
    path = f"{files.scratch_dir(spark)}/labelled-{uuid.uuid4().hex}"
    with_prompt_intent(turns, "text", judge=ON_AT).select("conv_id", "r").write.parquet(path)
    p = F.col("r.malicious_probability")
    return spark.read.parquet(path).groupBy(F.col("r.intent").alias("intent")).agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_distinct("conv_id").alias("n_conversations"),
        F.every(p.between(0, 1)).alias("probabilities_valid"), F.max(p).alias("highest"))
