import random

import pytest
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.functions.payload import estimate_tokens, text_payload
from rowjudge.operators.guards import CapExceeded, check_caps, dispatch_plan, would_send
from rowjudge.operators.packing import pack
from rowjudge.operators.question_sets import literal_set
from rowjudge.operators.requests import request_body, request_column, request_size
from rowjudge.questions import PROMPT_INTENT, make_question, parse_questions, single


def requests_of(spark, payloads, group="s"):
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    return df.select(F.lit(group).alias("scope"), F.lit("k").alias("set_key"), F.sha2("payload", 256).alias("entry_key"),
                     "payload", estimate_tokens("payload").alias("tokens"))


def sizes(batches):
    return sorted(r[0] for r in batches.select(F.size("items")).collect())


@pytest.mark.parametrize("texts, expected", [
    ([c * 600 for c in "abc"], [3]), ([c * 600 for c in "漢字語"], [1, 1, 1]), ([c * 300 for c in "джы"], [3])])
def test_scripts_fill_a_budget_differently(spark, texts, expected):
    fixed, row = request_size("rule-judge", single(make_question("the text is long")))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    payloads = [r[0] for r in df.select(text_payload("t")).collect()]
    batches = pack(requests_of(spark, payloads), JudgeConfig(max_batch_tokens=1500), fixed=fixed, row=row)
    assert sizes(batches) == expected


def test_every_row_is_over_a_one_token_budget(spark):
    assert sizes(pack(requests_of(spark, ["1", "2", "3"]), JudgeConfig(max_batch_tokens=1))) == [1, 1, 1]


def greedy(entries, cfg, fixed, row):
    batches, used = [], 0
    for key, tokens in sorted(entries):
        cost = tokens + row
        if not batches or len(batches[-1]) == cfg.batch_size or used + cost > cfg.max_batch_tokens:
            batches.append([])
            used = fixed
        batches[-1].append(key)
        used += cost
    return batches


@pytest.mark.parametrize("seed", range(3))
def test_packing_equals_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    cfg = JudgeConfig(batch_size=7, max_batch_tokens=900, rows_per_shard=40)
    rows = [(g, f"{g}{i}" + "x" * rng.randrange(2500)) for g in ("a", "b") for i in range(130 if g == "a" else 9)]
    df = spark.createDataFrame(rows, "scope string, payload string").select(
        "scope", F.lit("k").alias("set_key"), F.sha2("payload", 256).alias("entry_key"), "payload",
        estimate_tokens("payload").alias("tokens"))
    got = {(r.scope, r.shard, r.batch_no): [i.entry_key for i in r["items"]]
           for r in pack(df, cfg, fixed=20, row=5).collect()}
    want = {}
    entries = df.collect()
    for group in ("a", "b"):
        mine = [(e.entry_key, e.tokens) for e in entries if e.scope == group]
        shards = max(1, -(-len(mine) // cfg.rows_per_shard))
        for shard in range(shards):
            part = [e for e in mine if int(e[0][:8], 16) % shards == shard]
            want.update({(group, shard, n): keys for n, keys in enumerate(greedy(part, cfg, 20, 5))})
    assert got == want


def test_native_request_equals_the_text_form(spark):
    chosen = parse_questions({"a": {"type": "score", "question": 'say "x"', "levels": ["l\n", "h"]},
                              "b": {"type": "choice", "question": "é", "options": {"p": None, "q": "told"}}})
    payloads = [str(i) for i in range(12)] + ['{"price":1.50}', '"é"']
    for asked in (chosen, PROMPT_INTENT):
        body = spark.createDataFrame([(payloads,)], "p array<string>").select(
            request_column(F.lit('m"1'), literal_set(asked, 'm"1'), F.col("p"))).first()[0]
        assert body == request_body('m"1', asked, payloads)


def test_caps_and_plan(spark):
    check_caps(JudgeConfig(), 10**9, 10**12)
    check_caps(JudgeConfig(max_rows_per_run=10, max_payload_bytes_per_run=5), 10, 5)
    with pytest.raises(CapExceeded, match="max_rows_per_run = 10"):
        check_caps(JudgeConfig(max_rows_per_run=10), 11, 0)
    with pytest.raises(CapExceeded, match="max_payload_bytes_per_run = 5"):
        check_caps(JudgeConfig(max_payload_bytes_per_run=5), 1, 6)
    cfg = JudgeConfig(requests_per_minute=1200)
    misses = requests_of(spark, [f'"prompt {i}"' for i in range(1000)])
    assert tuple(would_send(misses, "scope").first()) == ("s", 1000, sum(len(f'"prompt {i}"') for i in range(1000)))
    plan = dispatch_plan(pack(misses, cfg, fixed=259, row=104), cfg, fixed=259, row=104).first()
    tokens = 40 * 259 + sum(104 + (len(f'"prompt {i}"') + 2) // 3 for i in range(1000))
    assert (plan.requests, plan.rows, plan.estimated_tokens, plan.floor_seconds) == (40, 1000, tokens, 2.0)
    assert plan.estimated_usd == pytest.approx(tokens * 0.042 / 1e6)
