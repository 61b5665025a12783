"""Payloads, keys, packing, guards and the answer store, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.functions import judging as J
from rowjudge.functions.payload import estimate_tokens, payload_bytes, row_payload, value_payload
from rowjudge.operators.dedupe import distinct_requests, split_fates, with_entry_key
from rowjudge.operators.guards import dispatch_plan as plan_of
from rowjudge.operators.guards import would_send
from rowjudge.operators.keys import entry_key
from rowjudge.operators.packing import SHARD_BYTES, pack
from rowjudge.operators.question_sets import compile_question_column
from rowjudge.operators.requests import request_size
from rowjudge.operators.single_flight import flight_counts
from rowjudge.queries.judging import (CUSTOMER_COLUMNS, CUSTOMER_SQL, ORDER_SQL, TEXT_PAYLOAD, TOKENS_SQL, documents,
                                      prompts)
from rowjudge.queries.registry import PROMPT_SQL, noul_sql, payload_sql, query
from rowjudge.questions import PROMPT_INTENT
from rowjudge.sources.answer_store import keep_youngest, latest
from rowjudge.sources.tables import table

CFG = JudgeConfig()
FIXED, ROW = request_size(CFG.model, PROMPT_INTENT)
# Small shards, so that the test tables fill more than one.
PACKING = CFG.with_(rows_per_shard=64)


# -- payloads -------------------------------------------------------------------------------

@query(f"SELECT o_orderkey, {ORDER_SQL} AS payload FROM orders")
def payload_row(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return orders.select("o_orderkey", row_payload(orders).alias("payload"))


@query(f"SELECT c_custkey, {CUSTOMER_SQL} AS payload, concat('{{\"c_name\":', to_json(c_name), '}}') AS name_only FROM customer")
def payload_subset(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer")
    return people.select("c_custkey", row_payload(people, CUSTOMER_COLUMNS).alias("payload"),
                         row_payload(people, ["c_name"]).alias("name_only"))


@query(f"""
SELECT doc_id, {TEXT_PAYLOAD} AS text_payload, CAST(n_chars AS VARCHAR) AS number_payload,
  CASE WHEN lang = 'en' THEN 'true' ELSE 'false' END AS flag_payload FROM documents""")
def payload_scalar(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("is_english", F.col("lang") == "en")
    return docs.select("doc_id", value_payload(docs, "text").alias("text_payload"),
                       value_payload(docs, "n_chars").alias("number_payload"),
                       value_payload(docs, "is_english").alias("flag_payload"))


@query("""
SELECT vec_id, concat('{"vec_id":', vec_id, ',"steps":[',
  array_to_string([CAST(floor(CAST(x AS DOUBLE) * 1000) AS INTEGER) for x in embedding], ','),
  '],"tag":{"label":', label, ',"name":"vecto"},"by_name":{"vector":"a lon","', label, '":null}}') AS payload
FROM embeddings""")
def payload_nested(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    nested = vectors.select(
        "vec_id",
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int")).alias("steps"),
        F.struct("label", F.lit("vector").alias("name")).alias("tag"),
        F.create_map(F.lit("vector"), F.lit("a long text"), F.col("label").cast("string"),
                     F.lit(None).cast("string")).alias("by_name"),
    )
    return nested.select("vec_id", row_payload(nested, max_value_chars=5).alias("payload"))


@query("""
SELECT l_orderkey, l_linenumber, concat('{"l_orderkey":', l_orderkey, ',"price":', CAST(l_extendedprice AS DECIMAL(12,2)),
  ',"l_shipdate":"', CAST(l_shipdate AS VARCHAR), '","day":"', CAST(CAST(l_shipdate AS DATE) AS VARCHAR),
  '","odd":null,"flag":', CASE WHEN l_returnflag = 'R' THEN 'true' ELSE 'false' END,
  ',"raw":"', to_base64(encode(l_returnflag)), '"}') AS payload
FROM lineitem""")
def payload_typed(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    typed = lines.select(
        "l_linenumber", "l_orderkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"), "l_shipdate",
        F.col("l_shipdate").cast("date").alias("day"),
        F.when(F.col("l_discount") > 0.05, float("nan")).otherwise(float("-inf")).alias("odd"),
        (F.col("l_returnflag") == "R").alias("flag"), F.encode("l_returnflag", "UTF-8").alias("raw"))
    columns = ["l_orderkey", "price", "l_shipdate", "day", "odd", "flag", "raw"]
    return typed.select("l_orderkey", "l_linenumber", row_payload(typed, columns).alias("payload"))


@query(f"""
SELECT payload, count(*) AS n_rows FROM (SELECT {payload_sql("text", 10)} AS payload FROM documents) GROUP BY payload""")
def truncate_collapse(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return distinct_requests(docs.select(value_payload(docs, "text", max_value_chars=10).alias("payload")), ["payload"])


@query(f"""
SELECT doc_id, {TOKENS_SQL} AS tokens, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes
FROM (SELECT doc_id, {TEXT_PAYLOAD} AS payload FROM documents)""")
def token_estimate(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", estimate_tokens("payload").alias("tokens"),
                       payload_bytes("payload").alias("payload_bytes"))


# -- questions and keys ---------------------------------------------------------------------

def _identity_sql(query_text: str, descriptions: str) -> str:
    return (f"""sha256(concat('[{{"name":"q","pointer":"","kind":"noul","query":', to_json({query_text}),
      ',"options":[],"descriptions":[{descriptions}]}}]'))""")


_SEGMENT = "concat('the segment is ', lower(c_mktsegment))"


@query(f"""
SELECT {_identity_sql(_SEGMENT, "")} AS plain_key, {_identity_sql(_SEGMENT, '"it is","it is not"')} AS described_key,
  {_identity_sql(_SEGMENT, "")} <> {_identity_sql(_SEGMENT, '"it is","it is not"')} AS differ,
  c_mktsegment AS segment, count(*) AS n_rows FROM customer GROUP BY ALL""")
def set_key_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Per-row question texts; the criteria are part of a set's identity."""
    people = table(spark, sf, "customer")
    question = F.concat(F.lit("the segment is "), F.lower("c_mktsegment"))
    told = F.struct(F.lit("it is").alias("true"), F.lit("it is not").alias("false"))

    def text(*extra):
        return F.to_json(F.struct(F.struct(F.lit("Noul").alias("type"), question.alias("question"), *extra).alias("q")))

    asked = people.select(F.col("c_mktsegment").alias("segment"), text().alias("plain"),
                          text(told.alias("criteria")).alias("described"))
    sets = distinct_requests(asked, ["segment", "plain", "described"])
    sets = compile_question_column(sets, "plain", CFG.model, into="p")
    sets = compile_question_column(sets, "described", CFG.model, into="d")
    return sets.select("segment", "n_rows", F.col("p.set_key").alias("plain_key"),
                       F.col("d.set_key").alias("described_key"),
                       (F.col("p.set_key") != F.col("d.set_key")).alias("differ"))


def key_sql(scope: str, payload: str, model: str = CFG.model, set_key: str = PROMPT_INTENT.set_key) -> str:
    return (f"sha256(concat(octet_length(encode({scope})), ':', {scope}, chr(31), '{len(model)}:{model}', chr(31), "
            f"'{set_key}', chr(31), {payload}))")


@query(f"""
SELECT doc_id, {key_sql("source", "payload")} AS entry_key, {key_sql("source", "payload", "other-judge")} AS other_model_key,
  {key_sql("''", "payload")} AS unscoped_key FROM (SELECT doc_id, source, {TEXT_PAYLOAD} AS payload FROM documents)""")
def entry_keys(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    set_key, payload = F.lit(PROMPT_INTENT.set_key), F.col("payload")
    return docs.select(
        "doc_id",
        entry_key(F.col("source"), F.lit(CFG.model), set_key, payload).alias("entry_key"),
        entry_key(F.col("source"), F.lit("other-judge"), set_key, payload).alias("other_model_key"),
        entry_key(F.lit(None), F.lit(CFG.model), set_key, payload).alias("unscoped_key"))


# -- packing --------------------------------------------------------------------------------

def document_misses(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct documents, as requests that all have to be sent."""
    docs = documents(spark, sf).select(F.lit("").alias("scope"), "payload")
    keyed = with_entry_key(distinct_requests(docs, ["scope", "payload"]), CFG.model, F.lit(PROMPT_INTENT.set_key))
    return keyed.select("scope", F.lit(PROMPT_INTENT.set_key).alias("set_key"), "entry_key", "payload",
                        estimate_tokens("payload").alias("tokens"))


def packing_sql(batch_size: int, budget: int, rows_per_shard: int = PACKING.rows_per_shard) -> str:
    """The greedy cut as a recursion over the rank inside each shard."""
    return f"""
  m AS (SELECT DISTINCT {TEXT_PAYLOAD} AS payload FROM documents),
  k AS (SELECT {key_sql("''", "payload")} AS entry_key, payload, {TOKENS_SQL} AS tokens FROM m),
  c AS (SELECT CAST(greatest(ceil(count(*) / {rows_per_shard}.0),
          ceil(sum(octet_length(encode(payload))) / {SHARD_BYTES}.0)) AS BIGINT) AS shards FROM k),
  s AS (SELECT entry_key, payload, tokens, CAST(('0x' || substring(entry_key, 1, 8))::BIGINT % shards AS INTEGER) AS shard
        FROM k, c),
  o AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY entry_key) AS rn FROM s),
  f AS (SELECT shard, rn, entry_key, tokens, 0 AS batch_no, 1 AS n, {FIXED} + tokens + {ROW} AS used FROM o WHERE rn = 1
    UNION ALL
    SELECT o.shard, o.rn, o.entry_key, o.tokens,
      CASE WHEN f.n = {batch_size} OR f.used + o.tokens + {ROW} > {budget} THEN f.batch_no + 1 ELSE f.batch_no END,
      CASE WHEN f.n = {batch_size} OR f.used + o.tokens + {ROW} > {budget} THEN 1 ELSE f.n + 1 END,
      CASE WHEN f.n = {batch_size} OR f.used + o.tokens + {ROW} > {budget} THEN {FIXED} ELSE f.used END + o.tokens + {ROW}
    FROM f JOIN o ON o.shard = f.shard AND o.rn = f.rn + 1),
  b AS (SELECT shard, batch_no, count(*) AS n_items, min(entry_key) AS first_key, sum(tokens) AS payload_tokens
        FROM f GROUP BY shard, batch_no)"""


_BATCHES_SQL = """SELECT shard, batch_no, CAST(n_items AS INTEGER) AS n_items, first_key,
  CAST(payload_tokens AS BIGINT) AS payload_tokens FROM b"""


def _batch_rows(batches: DataFrame) -> DataFrame:
    tokens = F.aggregate("items", F.lit(0).cast("bigint"), lambda acc, item: acc + item["tokens"])
    return batches.select("shard", "batch_no", F.size("items").alias("n_items"),
                          F.element_at("items", 1)["entry_key"].alias("first_key"), tokens.alias("payload_tokens"))


@query(f"WITH RECURSIVE {packing_sql(25, 1 << 40)} {_BATCHES_SQL}")
def pack_rows(spark: SparkSession, sf: str) -> DataFrame:
    cfg = PACKING.with_(max_batch_tokens=1 << 40)
    return _batch_rows(pack(document_misses(spark, sf), cfg, fixed=FIXED, row=ROW))


@query(f"WITH RECURSIVE {packing_sql(25, 6000)} {_BATCHES_SQL}")
def pack_tokens(spark: SparkSession, sf: str) -> DataFrame:
    cfg = PACKING.with_(max_batch_tokens=6000)
    return _batch_rows(pack(document_misses(spark, sf), cfg, fixed=FIXED, row=ROW))


@query(f"WITH RECURSIVE {packing_sql(25, 1)} {_BATCHES_SQL}")
def pack_oversize(spark: SparkSession, sf: str) -> DataFrame:
    cfg = PACKING.with_(max_batch_tokens=1)
    return _batch_rows(pack(document_misses(spark, sf), cfg, fixed=FIXED, row=ROW))


@query(f"""
WITH RECURSIVE {packing_sql(25, CFG.max_batch_tokens, CFG.rows_per_shard)}
SELECT count(*) AS requests, CAST(sum(n_items) AS BIGINT) AS rows,
  CAST(sum({FIXED} + payload_tokens + n_items * {ROW}) AS BIGINT) AS estimated_tokens,
  count(*) * 60.0::DOUBLE / 1000 AS floor_seconds,
  CAST(sum({FIXED} + payload_tokens + n_items * {ROW}) AS BIGINT) * 0.042::DOUBLE / 1000000.0::DOUBLE AS estimated_usd FROM b""")
def dispatch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return plan_of(pack(document_misses(spark, sf), CFG, fixed=FIXED, row=ROW), CFG, fixed=FIXED, row=ROW)


@query(f"""
WITH m AS (SELECT DISTINCT user_id AS scope, {payload_sql(PROMPT_SQL)} AS payload FROM events)
SELECT scope, count(*) AS rows, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS payload_bytes, count(*) > 60 AS over_rows,
  sum(octet_length(encode(payload))) > 2000 AS over_bytes FROM m GROUP BY scope""")
def cap_check(spark: SparkSession, sf: str) -> DataFrame:
    """What a run per customer would send, against caps of 60 rows and 2,000 bytes."""
    rows = prompts(spark, sf)
    asked = rows.select(F.col("user_id").alias("scope"), value_payload(rows, "user_prompt").alias("payload"))
    sizes = would_send(distinct_requests(asked, ["scope", "payload"]), "scope")
    return sizes.withColumn("over_rows", F.col("rows") > 60).withColumn("over_bytes", F.col("payload_bytes") > 2000)


# -- store ----------------------------------------------------------------------------------

@query(f"""
WITH d AS (SELECT doc_id, {TEXT_PAYLOAD} AS payload FROM documents),
r AS (SELECT payload, count(*) AS n_rows FROM d GROUP BY payload),
s AS (SELECT DISTINCT payload FROM d JOIN labels USING (doc_id))
SELECT CASE WHEN s.payload IS NOT NULL THEN 'hit' ELSE 'miss' END AS fate, count(*) AS requests,
  CAST(sum(n_rows) AS BIGINT) AS n_rows,
  count(*) FILTER (s.payload IS NOT NULL AND {noul_sql("r.payload", "license")} >= 0.5) AS stored_yes
FROM r LEFT JOIN s ON r.payload = s.payload GROUP BY ALL""")
def cache_split(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled documents have been answered before; which of all documents are known?"""
    docs = documents(spark, sf)
    set_key = F.lit(PROMPT_INTENT.set_key)
    scoped = docs.select("doc_id", F.lit("").alias("scope"), "payload")
    answered = distinct_requests(scoped.join(table(spark, sf, "labels"), "doc_id", "left_semi"), ["scope", "payload"])
    answer = J.evaluate(F.col("payload"), "the text holds a license")
    known = with_entry_key(answered, CFG.model, set_key).select("entry_key", F.array(answer).alias("answers"))
    asked = with_entry_key(distinct_requests(scoped, ["scope", "payload"]), CFG.model, set_key)
    said_yes = F.get_json_object(F.col("answers")[0], "$.noul").cast("double") >= 0.5
    return split_fates(asked, known).groupBy("fate").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("n_rows").alias("n_rows"), F.count_if(said_yes).alias("stored_yes"))


@query(f"""
WITH p AS (SELECT user_id, {PROMPT_SQL} AS prompt, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id AS scope, CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_sent,
  CAST(sum(n) - count(*) AS BIGINT) AS rows_deduped,
  count(*) FILTER (user_id > (SELECT min(q.user_id) FROM p q WHERE q.prompt = p.prompt)) AS asked_again
FROM p GROUP BY user_id""")
def scope_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer pays for its own prompts: ``asked_again`` counts those that a customer
    before it had asked, which one shared namespace would not have sent again."""
    rows = prompts(spark, sf)
    asked = distinct_requests(rows.select(F.col("user_id").alias("query_id"),
                                          value_payload(rows, "user_prompt").alias("payload")), ["query_id", "payload"])
    shared = with_entry_key(asked.withColumn("scope", F.lit("")), CFG.model, F.lit(PROMPT_INTENT.set_key))
    counts = flight_counts(shared)
    sent = F.col("rows_sent") + F.col("shared_in_flight")
    return counts.select(F.col("query_id").alias("scope"), "rows_in", sent.alias("rows_sent"), "rows_deduped",
                         F.col("shared_in_flight").alias("asked_again"))


def answer_log(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as a log of answers: each customer's newest event type is its answer."""
    events = table(spark, sf, "events")
    key = F.sha2(F.col("user_id").cast("string"), 256)
    return events.select(F.lit(CFG.model).alias("model"), F.lit("").alias("scope"), F.lit("").alias("set_key"),
                         key.alias("entry_key"), F.array("event_type").alias("answers"),
                         F.col("event_id").alias("seq"), F.col("event_id").alias("age"))


@query("""
SELECT sha256(CAST(user_id AS VARCHAR)) AS entry_key, max_by(event_type, event_id) AS answer, max(event_id) AS seq,
  min(event_id) AS age FROM events GROUP BY user_id""")
def store_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest(answer_log(spark, sf)).select("entry_key", F.col("answers")[0].alias("answer"), "seq", "age")


@query("""
SELECT event_id, entry_key, age FROM (SELECT event_id, sha256(CAST(event_id AS VARCHAR)) AS entry_key,
    CAST(CAST(ts AS DATE) - DATE '1970-01-01' AS BIGINT) AS age FROM events)
QUALIFY row_number() OVER (ORDER BY age DESC, entry_key) <= 4000""")
def store_evict(spark: SparkSession, sf: str) -> DataFrame:
    """A store that keeps 4,000 answers, one append a day: the oldest go first."""
    events = table(spark, sf, "events")
    entries = events.select("event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("entry_key"),
                            F.unix_date(F.col("ts").cast("date")).cast("bigint").alias("age"))
    return keep_youngest(entries, 4000)


@query(f"""
WITH r AS (SELECT user_id % 4 AS query_id, {PROMPT_SQL} AS prompt, count(*) AS n FROM events GROUP BY ALL),
o AS (SELECT *, min(query_id) OVER (PARTITION BY prompt) AS owner FROM r)
SELECT query_id, CAST(sum(n) AS BIGINT) AS rows_in, count(*) FILTER (owner = query_id) AS rows_sent,
  count(*) FILTER (owner <> query_id) AS shared_in_flight, CAST(sum(n) - count(*) AS BIGINT) AS rows_deduped
FROM o GROUP BY query_id""")
def single_flight(spark: SparkSession, sf: str) -> DataFrame:
    """Four queries at once: each prompt is sent by the first of them that asks it."""
    rows = prompts(spark, sf)
    asked = rows.select((F.col("user_id") % 4).alias("query_id"), F.lit("").alias("scope"),
                        value_payload(rows, "user_prompt").alias("payload"))
    requests = distinct_requests(asked, ["query_id", "scope", "payload"])
    return flight_counts(with_entry_key(requests, CFG.model, F.lit(PROMPT_INTENT.set_key)))
