"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.llm import (conversations, hnsw, html_text, jaccard_join, language, mixing, packing, pii, product_quantisation, quality,
                          sharding, spelling, warc)
from rowjudge.sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def register(run):
    QUERIES[run.__name__] = run
    return run


@register
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    return found.withColumn("spans", pii.spans_text("spans"))


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@register
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.PackConfig(TOKENIZER))


@register
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@register
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.balanced_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def _fold(n: int):
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(n))


@register
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _fold(5) == 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label")).where(_fold(5) != 0)
    cfg = quality.QualityConfig()
    scored = quality.score(docs, quality.train(docs, labels, cfg), cfg)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= cfg.threshold).cast("int").alias("predicted"))


@register
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language.dictionaries(docs.where(_fold(4) != 2).select("text", "lang"))
    return language.predict(docs.select("doc_id", (_fold(4) == 2).alias("held_out"), "text"), known)


@register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))), "yyyyMMddHHmmss")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"), captured.alias("captured"))
    found = warc.capture_history(warc.archive_and_index(pages))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "place")


ORACLE_SQL["op2_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, lower(coalesce(url, '')) AS low,
  strftime(make_timestamp((1700000000 + coalesce(page_id, 0)) * 1000000), '%Y%m%d%H%M%S') AS captured FROM pages),
u AS (SELECT *, regexp_replace(regexp_extract(low, '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\.', '') AS host,
  regexp_replace(regexp_replace(low, '^[a-z][a-z0-9+.-]*://[^/?#]*', ''), '#.*$', '') AS rest FROM p),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS last, captured,
  concat(array_to_string(list_reverse(string_split(host, '.')), ','), ')', rest) AS url_key FROM u)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, CAST(5 * i // 4 + 1 AS INTEGER), 2) AS INTEGER) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to, url_key, captured,
  row_number() OVER (ORDER BY url_key, captured, page_id NULLS FIRST) - 1 AS place
FROM d"""


@register
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_quantisation.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op4_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(CAST(embedding AS DOUBLE[]), lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
    AND list_aggregate(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x)), 'max') > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x), n AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(comp.c, e.vec_id) AS component_id, coalesce(comp.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN comp ON e.vec_id = comp.x LEFT JOIN n ON e.vec_id = n.x"""


@register
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


@register
def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents")).drop("tag", "class")


ORACLE_SQL["op3_jaccard"] = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
ids AS (SELECT doc_id, hash(s) AS s FROM shingles), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM ids a JOIN ids b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM inter JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) ON x = d.doc_id"""


@register
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


#: The table of CRC-32 as SQL, worked out from its polynomial; the hashes below read it as ``crc.t``.
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a string column, in SQL."""
    byte = f"CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode({text}))), lambda i: {byte})), "
            "lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) + 1 AS INTEGER)])), 4294967295)")


ORACLE_SQL["op11_spelling"] = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents),
found AS (SELECT concat(d, ':', w) AS k, any_value(w) AS w, count(*) AS n FROM runs GROUP BY d, w),
hashed AS (SELECT w, n, {crc32_sql("k")} AS h FROM found, crc),
told AS (SELECT CASE WHEN h % 97 = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM told WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS d FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
pairs AS (SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.d = b.d AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN v b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN v b ON a.d = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM pairs GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN other END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM formed UNION ALL SELECT w.word, f.form FROM walk w JOIN formed f ON w.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN walk w USING (word) JOIN formed e ON w.at = e.word WHERE e.form IS NULL"""


@register
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return conversations.repair_report(given, conversations.damaged(given))


def _edits_sql(state: int) -> str:
    """The cheapest way on from a state: its cost, its edits and the turns that they give, the cost first."""
    made = conversations.MADE[state]
    role = "user" if made == 2 else "assistant"
    after = "CASE r.initial " + " ".join(f"WHEN '{'sua'[i]}' THEN p.s{to}" for i, to in conversations.AFTER[state].items()) + " END"
    cut = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    free = "fault IS NULL OR fault = 'truncated'"
    initials = ", ".join(f"'{'sua'[i]}'" for i in conversations.AFTER[state])
    return f"""list_min(list_filter([{{'c': 4 + p.s{state}.c, 'a': 'D' || p.s{state}.a, 'o': p.s{state}.o}},
      CASE WHEN ({free}) AND r.initial IN ({initials}) THEN {{'c': {cut} + ({after}).c, 'a': 'K' || ({after}).a,
        'o': list_prepend(concat(role, ':', text), ({after}).o)}} END,
      CASE WHEN {free} THEN {{'c': 3 + {cut} + p.s{made}.c, 'a': 'R' || p.s{made}.a,
        'o': list_prepend(concat('{role}:', text), p.s{made}.o)}} END], lambda x: x IS NOT NULL))"""


def _insert_sql(state: str, into: str, role: str) -> str:
    return f"list_min([{state}, {{'c': 3 + {into}.c, 'a': 'I' || {into}.a, 'o': list_prepend('{role}:', {into}.o)}}])"


ORACLE_SQL["op12_conversations"] = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS name FROM conversations),
kinds AS (SELECT *, {crc32_sql("name")} % 20 AS kind FROM named, crc),
rows AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) FROM kinds WHERE kind <> 0)),
trimmed AS (SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text))) AS i FROM rows),
told AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN body = '' THEN 'blank'
  WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
  concat(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i), substr(role, 1, 1)) AS two FROM trimmed),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (i > 1 AND two NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM told GROUP BY conv_id),
dp AS (SELECT conv_id, n AS i, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s0, {{'c': 6, 'a': 'II', 'o': ['user:', 'assistant:']}} AS s1,
    {{'c': 3, 'a': 'I', 'o': ['assistant:']}} AS s2, {{'c': 0, 'a': '', 'o': CAST([] AS VARCHAR[])}} AS s3 FROM sums
  UNION ALL SELECT conv_id, i, {_insert_sql("b0", "t2", "user")}, {_insert_sql("b1", "t2", "user")}, t2, {_insert_sql("b3", "t2", "user")}
  FROM (SELECT conv_id, i, b0, b1, b3, {_insert_sql("b2", "b3", "assistant")} AS t2
    FROM (SELECT p.conv_id, p.i - 1 AS i, {_edits_sql(0)} AS b0, {_edits_sql(1)} AS b1, {_edits_sql(2)} AS b2, {_edits_sql(3)} AS b3
      FROM dp p JOIN told r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(CAST(s0.c AS BIGINT), 0) AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(array_to_string(s0.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM c.conv_id AND dp.i = 0"""


@register
def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


#: Reads pages that mark their article by its element, hold no other element that goes inside it and no rarer character references.
ORACLE_SQL["op13_html_text"] = r"""
WITH cut AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)(?:</article>|<footer>|$)', 1) AS body FROM pages),
pieces AS (SELECT page_id, url, list_transform(regexp_split_to_array(body, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(
  replace(replace(replace(replace(regexp_replace(replace(regexp_replace(x, '</?b>', '', 'g'), '<br>', ' '), '&quot;?', '"', 'g'),
    '&#x27;', ''''), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '[ \t\n\v\f\r]+', ' ', 'g'))) AS parts FROM cut),
texts AS (SELECT page_id, url, regexp_replace(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '&amp;?', '&', 'g') AS text
  FROM pieces)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM texts"""
