import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.functions import answers as A
from rowjudge.functions.payload import row_payload, value_payload
from rowjudge.judges.callable import CallableJudge, JudgeError, NotReady
from rowjudge.operators.guards import CapExceeded
from rowjudge.plans import accounting
from rowjudge.plans.run import JudgingFailed, import_replies, judge_queries, judge_rows
from rowjudge.questions import PROMPT_INTENT, QuestionError, make_question, parse_questions, single
from rowjudge.sources.answer_store import AnswerStore
from rowjudge.sources.ledger import Ledger
from rowjudge.sources.reply_sink import ReplyWriter, supported
from tests.fake_judge import strict

STRICT = CallableJudge(strict)
MURALS = single(make_question("the person paints murals"))
CODER = single(make_question("the person builds sailboats"))


@pytest.fixture
def kit(spark, tmp_path):
    return {"store": AnswerStore(spark, str(tmp_path / "store")), "ledger": Ledger(spark, str(tmp_path / "ledger"))}


def counts(run, *names):
    return tuple(run.report[n] for n in names)


def noul(run):
    return [r[0] for r in run.rows.orderBy("id").select(A.number_field(F.col("answers")[0], "noul")).collect()]


def test_thirty_prompts_then_all_hits(spark, prompts, kit):
    payload = value_payload(prompts, "user_prompt")
    first = judge_rows(prompts, payload, PROMPT_INTENT, STRICT, **kit)
    assert counts(first, "requests", "rows_sent", "cache_hits") == (2, 30, 0)
    assert first.report["input_tokens"] > 0 and first.report["output_tokens"] == 60
    judged = first.rows.select("id", A.prompt_intent_of(F.col("answers")[0], F.col("answers")[1]).alias("r"))
    top = judged.groupBy((F.col("id") % 4 == 0).alias("f")).agg(F.max("r.malicious_probability")).collect()
    assert dict(map(tuple, top)) == {False: 0.1, True: 0.9}
    assert first.rows.columns == ["id", "user_prompt", "answers"]
    second = judge_rows(prompts, payload, PROMPT_INTENT, STRICT, **kit)
    assert counts(second, "requests", "rows_sent", "cache_hits") == (0, 0, 30)
    assert second.rows.where("answers IS NULL").count() == 0
    books = accounting.run_report(kit["ledger"].runs(), kit["ledger"].batches()).orderBy("seq").collect()
    assert [(r.requests, r.rows_sent, r.cache_hits) for r in books] == [(2, 30, 0), (0, 0, 30)]
    last = accounting.last_report(kit["ledger"].runs(), kit["ledger"].batches(), spark.sparkContext.applicationId)
    assert last.first().seq == 2
    total = accounting.engine_stats(kit["ledger"].runs(), kit["ledger"].batches(), kit["store"].latest()).first()
    assert (total.requests, total.rows_evaluated, total.cache_hits, total.cached_answers) == (2, 30, 30, 30)
    assert kit["store"].clear()
    assert judge_rows(prompts, payload, PROMPT_INTENT, STRICT, **kit).report["rows_sent"] == 30


def test_duplicates_are_sent_once(spark):
    df = spark.range(12).select(F.concat(F.lit("same prompt "), F.col("id") % 3).alias("p"))
    run = judge_rows(df, value_payload(df, "p"), PROMPT_INTENT, STRICT)
    assert counts(run, "rows_in", "rows_sent", "requests", "rows_deduped") == (12, 3, 1, 9)
    assert run.rows.where("answers IS NOT NULL").count() == 12


def test_scopes_pay_apart(people, kit):
    payload = row_payload(people)
    sent = [judge_rows(people, payload, MURALS, STRICT, scope=s, **kit).report["rows_sent"] for s in ("101", "101", "202", "")]
    assert sent == [3, 0, 3, 3]
    assert {(r.scope, r.requests) for r in accounting.scope_spend(kit["ledger"].batches()).where("model IS NOT NULL").collect()} \
        == {("101", 1), ("202", 1), ("", 1)}


def test_scope_from_a_column(people):
    run = judge_rows(people.withColumn("who", F.lit("x")).unionByName(people.withColumn("who", F.lit("y"))),
                     value_payload(people, "note"), MURALS, STRICT, scope=F.col("who"))
    assert counts(run, "rows_sent", "requests") == (6, 2)  # a request never mixes two scopes


def test_another_model_is_another_answer(people, kit):
    def sent(model):
        return judge_rows(people, row_payload(people), MURALS, STRICT, cfg=JudgeConfig(model=model), **kit).report["rows_sent"]

    assert [sent("one"), sent("two"), sent("one")] == [3, 3, 0]


def test_batch_size_and_budget(people):
    def requests(**settings):
        return judge_rows(people, row_payload(people), MURALS, STRICT, cfg=JudgeConfig(**settings)).report["requests"]

    assert requests() == 1 and requests(batch_size=1) == 3 and requests(max_batch_tokens=1) == 3


def test_several_questions_are_one_request(people, kit):
    asked = parse_questions({"team": {"type": "choice", "question": "which team?", "options": {"a": "x", "b": None}},
                             "coder": {"type": "noul", "question": "the person builds sailboats"},
                             "senior": {"type": "score", "question": "how senior?", "levels": ["l", "h"]}})
    run = judge_rows(people, row_payload(people), asked, STRICT, **kit)
    assert counts(run, "requests", "rows_sent") == (1, 3)
    names = F.array(*[F.lit(n) for n in asked.names])
    whole = json.loads(run.rows.orderBy("id").select(A.answer_object(names, F.col("answers"))).first()[0])
    assert list(whole) == ["team", "coder", "senior"] and whole["coder"]["noul"] == 0.9 and whole["team"]["explained"] == ["a"]
    assert judge_rows(people, row_payload(people), asked, STRICT, **kit).report["rows_sent"] == 0


def test_question_sets_from_a_column(people):
    one = '{"coder": {"type": "noul", "question": "the person builds sailboats"}}'
    same = '{ "coder" : {"question": "the person builds sailboats", "type": "NOUL"} }'
    two = '{"coder": {"type": "noul", "question": "the person builds sailboats"}, "s": {"type": "noul", "question": "x banjo"}}'
    asked = F.when(F.col("id") == 1, two).when(F.col("id") == 2, one).otherwise(same)
    run = judge_rows(people, row_payload(people), asked, STRICT)
    assert counts(run, "requests", "rows_sent") == (2, 3)  # differing text of one set is one set
    assert noul(run) == [0.9, 0.1, 0.1]
    run = judge_rows(people, F.lit('"x"'), F.when(F.col("id") == 2, one).when(F.col("id") == 3, same), STRICT)
    assert counts(run, "requests", "rows_sent", "rows_null", "rows_deduped") == (1, 1, 1, 1)
    assert noul(run) == [None, 0.1, 0.1]
    with pytest.raises(Exception, match="has no field"):
        judge_rows(people, row_payload(people), F.lit('{"q": {"type": "noul", "question": "?", "x": 1}}'), STRICT)


def test_a_failed_set_keeps_what_was_paid(people, kit):
    ask = '{"q": {"type": "noul", "question": "%s"}}'
    asked = F.when(F.col("id") == 1, ask % "this one is forbidden").otherwise(ask % "the person builds sailboats")
    with pytest.raises(JudgingFailed, match="1 rows got no answer: refused"):
        judge_rows(people, row_payload(people), asked, STRICT, **kit)
    assert [(r.error, json.loads(r.payload)["id"]) for r in kit["ledger"].dead_letters().collect()] == [("refused", 1)]
    run = judge_rows(people, row_payload(people), CODER, STRICT, **kit)
    assert counts(run, "rows_sent", "cache_hits") == (1, 2) and noul(run) == [0.9, 0.1, 0.1]


@pytest.mark.parametrize("question, attempts, error", [
    ("is it swamped", 2, "overloaded"), ("is it unplugged", 2, "connection dropped"), ("is it forbidden", 1, "refused"),
    ("is it crashing", 1, "ValueError: a bug"), ("is it speechless", 1, "no answers object"), ("is it halfway", 1, "2 of 3 questions were answered")])
def test_attempts(people, kit, question, attempts, error):
    with pytest.raises(JudgingFailed, match=error):
        judge_rows(people, row_payload(people), single(make_question(question)), STRICT, resend_failed=False,
                   cfg=JudgeConfig(max_retries=2), **kit)
    tried = kit["ledger"].batches().collect()
    assert [r.status for r in tried] == ["failed"] * attempts and all(error in r.error for r in tried)
    assert kit["store"].latest().count() == 0


@pytest.mark.parametrize("size", [1, 2, 10])
def test_only_the_refused_row_dies(spark, kit, size):
    df = spark.range(1, 11).select("id", F.when(F.col("id") == 4, "a poisoned row").otherwise(F.concat(F.lit("row "), "id")).alias("t"))
    run = judge_rows(df, value_payload(df, "t"), MURALS, STRICT, cfg=JudgeConfig(batch_size=size), on_failure="keep", **kit)
    assert kit["ledger"].dead_letters().count() == 1 and run.report["reclaimed"] == (0 if size == 1 else size)
    assert [r.id for r in run.rows.where("answers IS NULL").collect()] == [4]
    sizes = [r.n_items for r in kit["ledger"].batches().where("status = 'failed'").collect()]
    assert len(sizes) == len(set(sizes))  # what was refused for good is never sent whole again
    again = judge_rows(df, value_payload(df, "t"), MURALS, STRICT, on_failure="keep", **kit)
    assert counts(again, "cache_hits", "rows_sent") == (9, 1)


def test_json_null_is_an_answer(people, kit):
    run = judge_rows(people, row_payload(people), single(make_question("is it unsure")), STRICT, **kit)
    assert counts(run, "rows_sent", "requests", "retries") == (3, 1, 0) and noul(run) == [None] * 3
    assert judge_rows(people, row_payload(people), single(make_question("is it unsure")), STRICT, **kit).report["cache_hits"] == 3


def test_a_batch_refused_for_one_row_recovers_the_rest(spark, tmp_path):
    marker = tmp_path / "seen"

    def refuses_once(request, timeout):
        if not marker.exists():
            marker.touch()
            raise JudgeError("not now", 422)
        return strict(request, timeout)

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    run = judge_rows(df, value_payload(df, "t"), MURALS, CallableJudge(refuses_once))
    assert counts(run, "reclaimed", "requests", "retries") == (2, 1, 1) and noul(run) == [0.1, 0.1]


def test_caps_refuse_before_anything_is_sent(prompts, spark, kit):
    payload = value_payload(prompts, "user_prompt")
    with pytest.raises(CapExceeded, match="max_rows_per_run = 10"):
        judge_rows(prompts, payload, PROMPT_INTENT, STRICT, cfg=JudgeConfig(max_rows_per_run=10), **kit)
    assert kit["store"].latest().count() == 0 and kit["ledger"].batches().count() == 0
    note = spark.sql("SELECT 1 AS id, repeat('x', 5000) AS note")
    capped = {"max_payload_bytes_per_run": 2100}
    judge_rows(note, row_payload(note, ["note"], max_value_chars=2000), MURALS, STRICT, cfg=JudgeConfig(**capped))
    with pytest.raises(CapExceeded, match="max_payload_bytes_per_run"):
        judge_rows(note, row_payload(note, ["note"], max_value_chars=0), MURALS, STRICT, cfg=JudgeConfig(**capped))
    # hits and duplicates do not count
    judge_rows(prompts, payload, PROMPT_INTENT, STRICT, **kit)
    assert judge_rows(prompts, payload, PROMPT_INTENT, STRICT, cfg=JudgeConfig(max_rows_per_run=1), **kit).report["cache_hits"] == 30


def test_readiness_is_asked_only_when_there_is_something_to_send(people, kit):
    def no_key():
        raise NotReady("no key")

    keyless = CallableJudge(strict, ready=no_key)
    with pytest.raises(NotReady):
        judge_rows(people, row_payload(people), MURALS, keyless, **kit)
    judge_rows(people, row_payload(people), MURALS, STRICT, **kit)
    assert judge_rows(people, row_payload(people), MURALS, keyless, **kit).report["cache_hits"] == 3
    assert judge_rows(people, F.lit(None).cast("string"), MURALS, keyless).report["rows_null"] == 3


def test_several_queries_share_one_flight(people):
    note = value_payload(people, "note")
    run = judge_queries({"a": (people, note), "b": (people, note), "c": (people.where("id = 1"), note)}, CODER, STRICT)
    seen = {r["query_id"]: (r["rows_in"], r["rows_sent"], r["shared_in_flight"]) for r in run.reports}
    assert seen == {"a": (3, 3, 0), "b": (3, 0, 3), "c": (1, 0, 1)}
    assert {r["requests"] for r in run.reports} == {1}
    assert run.rows.groupBy("query_id").count().orderBy("query_id").collect() == [("a", 3), ("b", 3), ("c", 1)]
    assert run.rows.where("answers IS NULL").count() == 0


def test_counters_add_up(spark, kit):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, (F.col("id") % 7).cast("string")).alias("t"))
    judge_rows(df.where("t < 3"), value_payload(df, "t"), MURALS, **kit)
    report = judge_rows(df, value_payload(df, "t"), MURALS, **kit).report
    parts = [report[n] for n in ("rows_null", "cache_hits", "rows_sent", "shared_in_flight", "rows_deduped")]
    assert report["rows_in"] == 100 == sum(parts) and report["rows_null"] == 10 and report["rows_sent"] == 4


def test_small_chunks(prompts):
    cfg = JudgeConfig(batch_size=2, concurrency=2, batches_per_task=2)
    run = judge_rows(prompts, value_payload(prompts, "user_prompt"), PROMPT_INTENT, STRICT, cfg=cfg)
    assert counts(run, "requests", "rows_sent") == (15, 30) and run.rows.where("answers IS NULL").count() == 0


def test_a_set_is_validated_on_the_driver():
    with pytest.raises(QuestionError):
        parse_questions("{}")


def test_a_trimmed_store_and_a_discarded_run(spark, prompts, kit):
    run = judge_rows(prompts, value_payload(prompts, "user_prompt"), PROMPT_INTENT, STRICT,
                     cfg=JudgeConfig(store_max_entries=12), **kit)
    assert kit["store"].log().count() == 12 and run.rows.where("answers IS NULL").count() == 0
    again = judge_rows(prompts, value_payload(prompts, "user_prompt"), PROMPT_INTENT, STRICT, **kit)
    assert counts(again, "cache_hits", "rows_sent") == (12, 18)
    run.discard()
    with pytest.raises(Exception, match="(?i)not.*exist"):
        run.rows.collect()


def test_the_timeout_reaches_the_call(people):
    def told(request, timeout):
        return strict(request, timeout) if timeout == 7.5 else "{}"

    run = judge_rows(people, row_payload(people), CODER, CallableJudge(told), cfg=JudgeConfig(timeout_seconds=7.5))
    assert noul(run) == [0.9, 0.1, 0.1]
    with pytest.raises(ValueError, match="has a column answers"):
        judge_rows(run.rows, row_payload(people), CODER)


def test_fields_instead_of_answers(people):
    fields = {"p": lambda answers: A.number_field(answers[0], "noul"), "kind": lambda answers: A.text_field(answers[0], "type")}
    run = judge_rows(people, row_payload(people), CODER, fields=fields)
    assert run.rows.columns == ["id", "name", "note", "p", "kind"]
    assert [(r.p, r.kind) for r in run.rows.orderBy("id").collect()] == [(0.9, "noul"), (0.1, "noul"), (0.1, "noul")]


def test_replies_survive_a_store_that_fails(people, kit, monkeypatch):
    def full(self, answers, rows):
        raise OSError("disk full")

    with monkeypatch.context() as patched:
        patched.setattr(AnswerStore, "append", full)
        with pytest.raises(OSError) as failed:
            judge_rows(people, row_payload(people), CODER, STRICT, **kit)
    work = failed.value.__notes__[0].split(" are in ")[1].split("/replies;")[0]
    assert import_replies(kit["store"], work) == 3
    assert judge_rows(people, row_payload(people), CODER, STRICT, **kit).report["rows_sent"] == 0


def test_debris_of_a_dead_append_costs_nothing(people, kit, tmp_path):
    (tmp_path / "store" / "run=000000001-000000001-000000001-0-1").mkdir(parents=True)
    assert [judge_rows(people, row_payload(people), CODER, STRICT, **kit).report["rows_sent"] for _ in range(2)] == [3, 0]


def batch_rows(n):
    return [pa.RecordBatch.from_pydict({"batch_id": [f"b{i}" for i in range(n)], "request": [str(i) for i in range(n)]})]


def test_a_task_tried_again_sends_only_what_was_not_committed(tmp_path):
    sent = []

    def call(rows):
        if "7" in rows.column("request").to_pylist() and len(sent) < 12:
            sent.append("lost")
            raise RuntimeError("the executor is gone")
        sent.extend(rows.column("request").to_pylist())
        return rows

    writer = ReplyWriter(call, str(tmp_path / "calls"), 3)
    for _ in range(6):
        with pytest.raises(RuntimeError):
            writer.write(iter(batch_rows(10)))
    halves = [batch_rows(10)[0].slice(0, 5), batch_rows(10)[0].slice(5)]  # batches may be cut elsewhere the next time
    assert writer.write(iter(halves)).chunks == 4
    assert [s for s in sent if s != "lost"] == [str(i) for i in range(10)]
    writer.commit([])
    found = pq.read_table(str(tmp_path / "calls")).column("batch_id").to_pylist()
    assert sorted(found) == sorted(f"b{i}" for i in range(10))


def test_a_worker_that_dies_costs_its_last_chunk_only(spark, kit, tmp_path):
    log, deadly = tmp_path / "sent", tmp_path / "deadly"
    deadly.touch()

    def dies(request, timeout):
        if deadly.exists() and log.exists() and len(log.read_text().splitlines()) >= 25:
            os._exit(1)
        with log.open("a") as out:
            out.write("one\n")
        return strict(request, timeout)

    df = spark.range(60).select("id", F.concat(F.lit("row "), "id").alias("t"))
    cfg = JudgeConfig(batch_size=1, concurrency=1, batches_per_task=10)
    with pytest.raises(Exception, match="(?i)worker|crash|exit"):
        judge_rows(df, value_payload(df, "t"), MURALS, CallableJudge(dies), cfg=cfg, **kit)
    deadly.unlink()
    assert kit["store"].latest().count() == 20
    run = judge_rows(df, value_payload(df, "t"), MURALS, CallableJudge(dies), cfg=cfg, **kit)
    assert counts(run, "cache_hits", "rows_sent") == (20, 40) and run.rows.where("answers IS NULL").count() == 0
    assert len(log.read_text().splitlines()) == 25 + 40
    assert len(kit["store"].runs()) == 2  # one append per run


def test_folders_that_only_spark_reaches(people, kit, monkeypatch):
    monkeypatch.setattr("rowjudge.plans.run.supported", lambda folder: False)
    run = judge_rows(people, row_payload(people), CODER, STRICT, **kit)
    assert noul(run) == [0.9, 0.1, 0.1] and counts(run, "requests", "rows_sent") == (1, 3)
    assert not supported("viewfs://store/x") and supported("/tmp/x") and supported("file:///tmp/x")


def test_resends_of_large_runs_shuffle_payloads_once(spark, monkeypatch):
    from rowjudge.plans import run as module

    plans, dealt = [], []

    class Counting(CallableJudge):
        def send(self, batches, cfg, folder):
            plans.append(batches._jdf.queryExecution().optimizedPlan().toString())
            dealt.append(batches.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), "batch_id").collect())
            super().send(batches, cfg, folder)

    def call(request, timeout):
        if '"bad' in request:
            raise JudgeError("refused", 422)
        return strict(request, timeout)

    rows = spark.range(400).select(F.concat(F.when(F.col("id") % 50 == 0, "bad").otherwise("fine"), F.lit(" paints murals "), F.col("id")).alias("t"))
    cfg = JudgeConfig(batch_size=4, rows_per_shard=2, concurrency=2)
    run = judge_rows(rows, value_payload(rows, "t"), MURALS, Counting(call), cfg=cfg, on_failure="keep")
    assert counts(run, "rows_sent", "rows_in") == (400, 400) and run.rows.where("answers IS NULL").count() == 8
    assert plans[0].count("Repartition") == 2 and "RepartitionByExpression [batch_id" not in plans[0]  # by shard, and the coalesce
    assert not os.path.exists(f"{run.work}/left-0")
    for job in dealt:
        parts = {}
        for r in sorted(job, key=lambda r: (r.part, r.at)):
            parts.setdefault(r.part, []).append(r.batch_id)
        assert len(parts) <= 2
    assert "Sort [batch_id" in plans[0]
