"""A judging run: every distinct unanswered payload is sent once, every row gets its answers.

    rows -> payload -> distinct requests -> known / unknown -> caps -> batches
         -> judge -> replies -> store and ledger -> answers joined back to the rows

The distinct requests and the replies are written tables, and replies are committed as they
come, so an executor that is lost makes a judge answer twice for the last few batches at most,
and the result that is handed back reads answers, it does not call for them. Input rows are read twice (once for the distinct
payloads, once for the result), each time with just the columns it needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.functions.payload import estimate_tokens
from rowjudge.judges.callable import deal
from rowjudge.judges.rule import RuleJudge
from rowjudge.operators.dedupe import distinct_requests, split_fates, with_entry_key
from rowjudge.operators.guards import USD_PER_MILLION_TOKENS, check_caps
from rowjudge.operators.keys import entry_key
from rowjudge.operators.lookup import HOT_ROWS, attach, hot_keys
from rowjudge.operators.packing import BROADCAST_GROUPS, dealt_shards, large_groups, pack, shards_of
from rowjudge.operators.question_sets import compile_question_column, literal_set
from rowjudge.operators.requests import request_column, request_size
from rowjudge.operators.single_flight import flight_counts
from rowjudge.questions import QuestionSet
from rowjudge.sources import files
from rowjudge.sources.answer_store import AnswerStore
from rowjudge.sources.ledger import RUNS, Ledger, columns as columns_of
from rowjudge.sources.reply_sink import supported

ANSWERS = "answers"
ROW_KEY = "_rowjudge_key"


class JudgingFailed(RuntimeError):
    """Some rows got no answer. Those that did are in the store: a new run pays for the rest."""


@dataclass
class JudgedRun:
    """``rows`` is the input with ``answers``: the raw JSON answers, in question order."""

    run_id: str
    rows: DataFrame
    reports: list[dict] = field(default_factory=list)
    work: str = ""

    def discard(self) -> None:
        """Delete the run's scratch tables, once ``rows`` is not needed any more."""
        files.delete(self.rows.sparkSession, self.work)

    @property
    def report(self) -> dict:
        if len(self.reports) != 1:
            raise ValueError("this run had several queries: see reports")
        return self.reports[0]


@dataclass
class _Run:
    spark: SparkSession
    cfg: JudgeConfig
    judge: object
    questions: QuestionSet | Column
    work: str
    run_id: str
    store: AnswerStore | None
    ledger: Ledger | None
    one_group: bool
    passes: list[str] = field(default_factory=list)
    left: DataFrame | None = None  # rows without an answer, after a dispatch
    again: DataFrame | None = None  # rows that were sent again
    tallies: list[Row] = field(default_factory=list)

    @property
    def per_row(self) -> bool:
        return isinstance(self.questions, Column)

    @property
    def commits(self) -> bool:
        """Whether the judge's tasks commit replies as they come."""
        return hasattr(self.judge, "send") and supported(self.work)

    def write(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = f"{self.work}/{name}"
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.parquet(path)

    # -- requests ------------------------------------------------------------------------

    def row_key(self, scope: Column, payload: Column, question: Column | None) -> Column:
        asked = F.lit(self.questions.set_key) if question is None else question
        return entry_key(scope, F.lit(self.cfg.model), asked, payload)

    def requests(self, rows: DataFrame) -> DataFrame:
        """The distinct requests of the run with their fate, as a written table."""
        by = ["query_id", "scope", "payload"] + (["question"] if self.per_row else [])
        distinct = distinct_requests(rows, by)
        if self.per_row:
            distinct = distinct.withColumn("row_key", self.row_key(F.col("scope"), F.col("payload"), F.col("question")))
            distinct = compile_question_column(distinct, "question", self.cfg.model).drop("question")
            distinct = with_entry_key(distinct, self.cfg.model, F.col("qset.set_key"))
            distinct = distinct.withColumn("set_key", F.col("qset.set_key"))
        else:
            distinct = with_entry_key(distinct, self.cfg.model, F.lit(self.questions.set_key))
            distinct = distinct.withColumn("row_key", F.col("entry_key"))
            distinct = distinct.withColumn("set_key", F.lit(self.questions.set_key))
        known = None
        if self.store is not None and self.store.runs():
            distinct = self.write(distinct, "asked")  # the look-up asks for its keys twice
            known = self.store.lookup(distinct)
        fates = split_fates(distinct, known)
        kept = F.when(F.col("fate") == "miss", F.col("payload"))
        return self.write(fates.withColumn("payload", kept), "requests", "fate")

    def misses(self, requests: DataFrame, once: bool) -> DataFrame:
        """The unknown requests, one row per key. Where several rows may meet a key they are grouped once, into a written table with
        the query that sends the key, as packing and the reports read them several times."""
        columns = ["scope", "set_key", "payload"] + (["qset"] if self.per_row else [])
        found = requests.where(F.col("fate") == "miss")
        if once:
            return found.select("entry_key", *columns)
        one = found.groupBy("entry_key").agg(*[F.first(c).alias(c) for c in columns], F.min("query_id").alias("query_id"))
        return self.write(one, "misses")

    def unanswered(self, misses: DataFrame, passes: list[str], dead: int) -> DataFrame:
        """The ``dead`` rows that these passes, one packing and its further attempts, left without an answer. Their failed batches
        hold them: all of the last pass, and those of earlier ones that were not tried again. Question sets of the rows' own are
        with the misses alone, and so is what a judge passed over."""
        found = self.spark.read.parquet(*[f"{self.work}/replies/{name}" for name in passes])
        last = (F.col("attempt") == len(passes)) | ~F.coalesce("retryable", F.lit(False))
        failed = found.where((F.col("status") != "ok") & last)
        if self.per_row or failed.agg(F.sum(F.when(F.size("payloads") == F.col("n_items"), F.col("n_items")))).first()[0] != dead:
            return misses.join(_answers(self.replies()), "entry_key", "left_anti")
        rows = failed.select("scope", "set_key", F.explode(F.arrays_zip("keys", "payloads")).alias("_row"))
        return rows.select("scope", "set_key", F.col("_row.keys").alias("entry_key"), F.col("_row.payloads").alias("payload"))

    # -- batches -------------------------------------------------------------------------

    def sharding(self, misses: DataFrame, rows: int, size: int) -> dict:
        if self.one_group:
            return {"shards": shards_of(rows, size, self.cfg)}
        large = large_groups(misses, ["scope", "set_key"], self.cfg)
        return {"few": large} if large.count() <= BROADCAST_GROUPS else {}

    def batches(self, misses: DataFrame, rows: int, size: int) -> DataFrame:
        sized = misses.withColumn("tokens", estimate_tokens("payload"))
        sharding = self.sharding(misses, rows, size)
        parts = dealt_shards(sharding["shards"], size, self.cfg) if self.commits and "shards" in sharding else None
        if parts:
            sharding["parts"] = parts
        if self.per_row:
            packed = pack(sized, self.cfg, carry=[F.first("qset").alias("qset")],
                          fixed=F.col("qset.fixed_tokens"), row=F.col("qset.row_tokens"), **sharding)
        else:
            fixed, row = request_size(self.cfg.model, self.questions)
            packed = pack(sized, self.cfg, fixed=fixed, row=row, **sharding)
        packed = packed.select(
            "scope", "set_key", *(["qset"] if self.per_row else []),
            F.element_at("items", 1)["entry_key"].alias("batch_id"),
            F.transform("items", lambda item: item["entry_key"]).alias("keys"),
            F.transform("items", lambda item: item["payload"]).alias("payloads"),
        )
        if parts:  # whole shards are dealt, so payloads move once
            packed = packed.sortWithinPartitions("batch_id").coalesce(self.cfg.concurrency)
        elif self.commits:  # dealt here: a request repeats its payloads, so it is made where it is sent
            packed = deal(packed, self.cfg)
        if not self.per_row:
            packed = packed.withColumn("qset", literal_set(self.questions, self.cfg.model))
        model = F.lit(self.cfg.model)
        return packed.select(
            F.lit(self.run_id).alias("run_id"),
            "batch_id",
            "scope",
            model.alias("model"),
            "set_key",
            F.size("keys").alias("n_items"),
            "keys",
            "payloads",
            F.col("qset.questions").alias("questions"),
            request_column(model, F.col("qset"), F.col("payloads")).alias("request"),
        )

    # -- sending -------------------------------------------------------------------------

    def send(self, batches: DataFrame, name: str, attempt: int) -> list[Row]:
        """Judge the batches in one job. Returns the tally of the replies: one row per status and
        retryability. Where tasks reach the scratch folder they commit replies as they come, and those of a job that fails
        count too."""
        if not hasattr(self.judge, "send"):
            return self.settle(self.judge.reply(batches, self.cfg), name, attempt)
        folder = f"{self.work}/calls/{name}"
        if not self.commits:
            parts = max(self.cfg.concurrency, -(-batches.count() // self.cfg.batches_per_task))
            return self.settle(self.judge.reply(batches.repartition(parts, "batch_id"), self.cfg), name, attempt)
        try:
            self.judge.send(batches, self.cfg, folder)
        except Exception:
            if files.exists(self.spark, folder):
                self.settle(self.judge.sent(batches, folder), name, attempt)
            raise
        return self.settle(self.judge.sent(batches, folder), name, attempt)

    def settle(self, replies: DataFrame, name: str, attempt: int) -> list[Row]:
        """Writes the replies and tallies them."""
        replies = replies.withColumn("attempt", F.lit(attempt))
        failed = F.col("status") != "ok"
        # needed again only after a failure, the request only by another attempt
        for column, again in (("payloads", failed), ("questions", failed), ("request", failed & F.col("retryable"))):
            replies = replies.withColumn(column, F.when(again, F.col(column)))
        replies = self.write(replies, f"replies/{name}")
        self.passes.append(name)
        tally = replies.groupBy("status", "retryable").agg(
            F.count(F.lit(1)).alias("requests"), F.sum("n_items").alias("rows"),
            F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens")).collect()
        self.tallies += tally
        return tally

    def keep_paid(self) -> None:
        """What is paid for goes to the store, then to the ledger, in one append each however many passes there were."""
        if not self.passes:
            return
        replies = self.replies()
        try:
            if self.store is not None and self.answered:
                self.store.append(_answers(replies), self.answered)
            if self.ledger is not None:
                self.ledger.append("batches", replies, self.run_id)
        except Exception as error:
            error.add_note(f"the replies are in {self.work}/replies; import_replies() puts them into a store")
            raise

    def dispatch(self, misses: DataFrame, rows: int, size: int, name: str) -> int:
        """All batches of one packing, and further attempts for the failures that are worth one. Returns the rows left without
        an answer."""
        before, earlier = self.answered, len(self.passes)
        batches = self.batches(misses, rows, size)
        tally = self.send(batches, f"{name}-0", 1)
        for attempt in range(2, self.cfg.max_retries + 1):
            if not any(t["status"] != "ok" and t["retryable"] for t in tally):
                break
            again = self.reply(-1).where((F.col("status") != "ok") & F.col("retryable")).select(*batches.columns)
            tally = self.send(deal(again, self.cfg) if self.commits else again, f"{name}-again{attempt}", attempt)
        dead = rows - (self.answered - before)
        self.left = self.unanswered(misses, self.passes[earlier:], dead) if dead else None
        return dead

    @property
    def answered(self) -> int:
        return sum(t["rows"] for t in self.tallies if t["status"] == "ok")

    def reply(self, at: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.work}/replies/{self.passes[at]}")

    def replies(self) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.work}/replies/{name}" for name in self.passes])


def _answers(replies: DataFrame) -> DataFrame:
    pair = F.explode(F.arrays_zip("keys", "answers")).alias("pair")
    return (replies.where(F.col("status") == "ok").select("model", "scope", "set_key", pair)
            .select("model", "scope", "set_key", F.col("pair.keys").alias("entry_key"),
                    F.col("pair.answers").alias(ANSWERS)))


def _reports(run: _Run, requests: DataFrame, todo: DataFrame, scope: str | None, reclaimed: int) -> list[dict]:
    """Counters per query of a run that several queries or question texts share. rows_in = null + hits + sent + shared + deduped.
    ``todo`` names the query that sends each key."""
    asked = requests.where(F.col("fate") == "miss")
    if run.per_row:  # several texts of one set meet a key
        asked = asked.groupBy("query_id", "entry_key").agg(F.sum("n_rows").alias("n_rows"))
    owners = todo.select("entry_key", "query_id")
    sent = flight_counts(asked, owners=owners).drop("rows_in")
    seen = requests.groupBy("query_id").agg(
        F.sum("n_rows").alias("rows_in"),
        F.sum(F.when(F.col("fate") == "null", F.col("n_rows")).otherwise(0)).alias("rows_null"),
        F.sum(F.when(F.col("fate") == "hit", F.col("n_rows")).otherwise(0)).alias("cache_hits"))
    counted = seen.join(sent, "query_id", "left")
    if reclaimed:  # rows sent again are those of the query that sent them first
        again = run.again.select("entry_key")
        counted = counted.join(again.join(owners, "entry_key").groupBy("query_id").agg(F.count(F.lit(1)).alias("reclaimed")), "query_id", "left")
    else:
        counted = counted.withColumn("reclaimed", F.lit(0).cast("bigint"))
    # one row per query of the run, however large the tables are
    return [_report(run, scope, row.asDict()) for row in counted.na.fill(0).orderBy("query_id").collect()]


def _report(run: _Run, scope: str | None, counted: dict) -> dict:
    """Requests are the answered ones; every failed attempt counts as a retry."""
    total = {name: sum(t[name] for t in run.tallies) for name in ("input_tokens", "output_tokens")}
    return {
        "run_id": run.run_id, "scope": scope, "model": run.cfg.model, **counted,
        "requests": sum(t["requests"] for t in run.tallies if t["status"] == "ok"),
        "retries": sum(t["requests"] for t in run.tallies if t["status"] != "ok"), **total,
        "estimated_cost_usd": total["input_tokens"] * USD_PER_MILLION_TOKENS / 1e6,
    }


def judge_rows(
    df: DataFrame,
    payload: Column,
    questions: QuestionSet | Column,
    judge=None,
    *,
    scope: str | Column = "",
    store: AnswerStore | None = None,
    ledger: Ledger | None = None,
    cfg: JudgeConfig | None = None,
    query_id: Column | None = None,
    on_failure: str = "raise",
    resend_failed: bool = True,
    fields: Mapping[str, Callable[[Column], Column]] | None = None,
) -> JudgedRun:
    """Judge every row of ``df``.

    ``questions`` is one set for all rows or a column of question-set texts. ``scope`` keeps
    answers of one customer from another; it is a value or a column, and is taken now, when the
    run happens. ``query_id`` marks several queries that share the run. With ``on_failure`` =
    ``keep`` rows without an answer stay NULL instead of failing the run. ``fields`` names columns
    to have instead of ``answers``, each a function of it: they are worked out once per distinct
    request, before the join-back, which then carries them and not the raw answers.
    """
    spark = df.sparkSession
    cfg = cfg or JudgeConfig.from_conf(spark)
    run_id = uuid.uuid4().hex
    run = _Run(spark, cfg, judge or RuleJudge(), questions, f"{files.scratch_dir(spark)}/run-{run_id}", run_id,
               store, ledger, isinstance(scope, str) and isinstance(questions, QuestionSet))
    fields = dict(fields or {ANSWERS: lambda answers: answers})
    taken = sorted(set(fields) & set(df.columns))
    if taken:
        raise ValueError(f"the input has a column {', '.join(taken)} already")

    fixed_scope = scope if isinstance(scope, str) else None
    scope_column = F.coalesce(scope.cast("string"), F.lit("")) if isinstance(scope, Column) else F.lit(scope)
    query = F.lit("0") if query_id is None else query_id.cast("string")
    asked = payload if not run.per_row else F.when(questions.isNotNull(), payload)
    columns = [query.alias("query_id"), scope_column.alias("scope"), asked.alias("payload")]
    requests = run.requests(df.select(*columns, *([questions.alias("question")] if run.per_row else [])))

    # a key is met once, unless several queries or several texts of one set may meet it
    once = query_id is None and not run.per_row
    todo = run.misses(requests, once)
    fates = {r["fate"]: r for r in requests.groupBy("fate").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("n_rows").alias("n_rows"),
        F.sum(F.octet_length("payload").cast("bigint")).alias("bytes")).collect()}
    rows, size = (fates["miss"]["keys"], fates["miss"]["bytes"]) if "miss" in fates else (0, 0)
    if rows and not once:
        rows, size = todo.agg(F.count(F.lit(1)), F.sum(F.octet_length("payload").cast("bigint"))).first()
    dead, reclaimed = 0, 0
    if rows:
        run.judge.require_ready()
        check_caps(cfg, rows, size)
        if store is not None:
            store.check_writable()
        try:
            dead = run.dispatch(todo, rows, size, "first")
            if dead and resend_failed:
                reclaimed, dead = _send_in_halves(run, dead, size)
        finally:
            run.keep_paid()
    if once:
        n = {fate: fates[fate]["n_rows"] if fate in fates else 0 for fate in ("null", "hit", "miss")}
        counted = {"query_id": "0", "rows_in": sum(n.values()), "rows_null": n["null"], "cache_hits": n["hit"],
                   "rows_sent": rows, "shared_in_flight": 0, "rows_deduped": n["miss"] - rows, "reclaimed": reclaimed}
        reports = [_report(run, fixed_scope, counted)]
    else:
        reports = _reports(run, requests, todo, fixed_scope, reclaimed)
    _keep_books(run, reports)
    if store is not None and rows:
        store.trim(cfg.store_max_entries)
    if dead:
        first_error = _bury(run, run.left)
        if on_failure == "raise":
            raise JudgingFailed(f"{dead} rows got no answer: {first_error}")
    total = sum(fate["n_rows"] for fate in fates.values())
    return JudgedRun(run_id, _with_answers(run, df, requests, total, once, columns, fields), reports,
                     run.work)


def _send_in_halves(run: _Run, dead: int, size: int) -> tuple[int, int]:
    """Failed batches once more, in batches of half the size each time: what one row spoils costs the others nothing in the
    end, and no refused batch is sent whole again. Single rows get one more try, unless they were refused for good. Returns the
    rows sent again and those left without an answer."""
    cfg, again, turn = run.cfg, 0, 0
    while dead:
        unsent = left = run.left
        n = dead
        if run.cfg.batch_size == 1:
            keys = run.replies().where((F.col("status") != "ok") & F.col("retryable") & (F.col("n_items") == 1))
            left = left.join(keys.select(F.explode("keys").alias("entry_key")).distinct(), "entry_key", "left_semi")
        if run.cfg.batch_size == 1 or not run.one_group:  # else packing alone reads them, from the failed replies
            left = run.write(left, f"left-{turn}")
        if run.cfg.batch_size == 1:
            n = left.count()
        if not again:
            again, run.again = n, left
        if n:
            last = run.cfg.batch_size == 1
            run.cfg = run.cfg.with_(batch_size=max(1, run.cfg.batch_size // 2))
            dead -= n - run.dispatch(left, n, size, f"again-{turn}")
            if last:  # those that were refused for good were not sent again
                spared = unsent.join(left.select("entry_key"), "entry_key", "left_anti")
                run.left = spared if run.left is None else run.left.unionByName(spared)
            turn += 1
        if not n or last:
            break
    run.cfg = cfg
    return again, dead


def import_replies(store: AnswerStore, work: str) -> int:
    """Puts the answered batches of a run's scratch folder into a store, where the run itself couldn't; returns their rows."""
    spark, folder = store.spark, f"{work}/replies"
    found = [spark.read.parquet(f"{folder}/{name}") for name in files.list_dirs(spark, folder)
             if files.exists(spark, f"{folder}/{name}/_SUCCESS")]
    rows = 0
    for replies in found:
        answers = _answers(replies)
        if n := answers.count():
            store.append(answers, n)
            rows += n
    return rows


def _keep_books(run: _Run, reports: list[dict]) -> None:
    if run.ledger is None or not reports:
        return
    session, seq = run.spark.sparkContext.applicationId, run.ledger.next_seq()
    rows = [tuple({**r, "session_id": session, "seq": seq}[name] for name in columns_of(RUNS)) for r in reports]
    run.ledger.append("runs", run.spark.createDataFrame(rows, RUNS), run.run_id)


def _bury(run: _Run, left: DataFrame) -> str:
    """Write the dead letters, each with the last error of its batch; returns one error."""
    failed = (run.replies().where(F.col("status") != "ok")
              .select("model", F.explode("keys").alias("entry_key"), "error"))
    last = failed.groupBy("entry_key").agg(F.first("model").alias("model"), F.max("error").alias("error"))
    letters = run.write(left.join(last, "entry_key", "left").withColumn("run_id", F.lit(run.run_id)), "dead_letters")
    if run.ledger is not None:
        run.ledger.append("dead_letters", letters, run.run_id)
    return letters.agg(F.min("error")).first()[0]


def _with_answers(run: _Run, df: DataFrame, requests: DataFrame, total: int, once: bool,
                  columns: list[Column], fields: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """The rows with their answers; lazy, and reading written answers only. When each key is met
    ``once`` it is the rows' key, and a sent answer needs no way back to it."""
    hits = requests.where(F.col("fate") == "hit").select("row_key", ANSWERS)
    resolved = hits
    counts = requests.select("row_key", "n_rows")
    if run.passes:
        sent = _answers(run.replies()).select("entry_key", ANSWERS)
        if not once:
            keys = requests.where(F.col("fate") == "miss").select("row_key", "entry_key").distinct()
            sent = keys.join(sent, "entry_key").drop("entry_key")
        resolved = hits.unionByName(sent.toDF("row_key", ANSWERS))
    if not once:
        resolved = resolved.dropDuplicates(["row_key"])
        counts = counts.groupBy("row_key").agg(F.sum("n_rows").alias("n_rows"))
    _, scope, asked = columns
    question = run.questions if run.per_row else None
    keyed = df.withColumn(ROW_KEY, run.row_key(scope, asked, question))
    resolved = resolved.select(F.col("row_key").alias(ROW_KEY),
                               *[use(F.col(ANSWERS)).alias(name) for name, use in fields.items()])
    if total < HOT_ROWS:  # too few rows for a hot key
        return keyed.join(resolved, ROW_KEY, "left").drop(ROW_KEY)
    hot = hot_keys(counts, "row_key", total).withColumnRenamed("row_key", ROW_KEY)
    return attach(keyed, resolved, ROW_KEY, hot).drop(ROW_KEY)


def judge_queries(queries: Mapping[str, tuple[DataFrame, Column]], questions: QuestionSet, judge=None,
                  **options) -> JudgedRun:
    """Several queries over the same questions in one run: a payload that more than one of them
    asks about is sent once. ``rows`` has ``query_id`` and ``answers`` beside the payload."""
    parts = [df.select(F.lit(name).alias("query_id"), payload.alias("payload"))
             for name, (df, payload) in queries.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return judge_rows(rows, F.col("payload"), questions, judge, query_id=F.col("query_id"), **options)
