"""A judge behind a caller-supplied function: request text in, reply text out.

The transport is the caller's. Each worker gets whole batches through Arrow and commits replies
as they come; they are taken apart by native expressions.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowjudge.config import JudgeConfig
from rowjudge.sources.reply_sink import write_replies

# Statuses below 500 that are worth another attempt.
RETRYABLE = (408, 429, 529)

_CALL_FIELDS = (
    T.StructType()
    .add("response", "string")
    .add("status_code", "integer")
    .add("call_error", "string")
    .add("call_retryable", "boolean")
    .add("api_ms", "double")
)

_CALL_TYPES = (pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.float64())

_REPLY = ("answers map<string,string>, "
          "usage struct<input_tokens: bigint, output_tokens: bigint>")


def deal(batches: DataFrame, cfg: JudgeConfig) -> DataFrame:
    """The batches for at most ``concurrency`` tasks, in an order that every try of a task meets again."""
    return batches.repartition(cfg.concurrency, "batch_id").sortWithinPartitions("batch_id")


def _called(batches: DataFrame) -> T.StructType:
    return T.StructType([*batches.schema.fields, *_CALL_FIELDS.fields])


class JudgeError(Exception):
    """A refused or failed request. Without a status it is a transport failure, which may be
    tried again."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status

    @property
    def retryable(self) -> bool:
        return self.status is None or self.status in RETRYABLE or self.status >= 500

    def __reduce__(self):
        return JudgeError, (str(self), self.status)


class NotReady(RuntimeError):
    """Raised before anything is sent when the judge cannot be called at all."""


class CallableJudge:
    """``call(request, timeout_seconds) -> reply``, the timeout being the run's setting. ``ready``
    may raise :class:`NotReady`; it is asked only when there is something to send."""

    def __init__(self, call: Callable[[str, float], str], *, ready: Callable[[], None] | None = None):
        self.call = call
        self.ready = ready

    def require_ready(self) -> None:
        if self.ready is not None:
            self.ready()

    def _caller(self, timeout: float) -> Callable[[pa.Table], pa.Table]:
        """Rows with a ``request`` to the same rows with what came of it."""
        call = self.call

        def one(request: str) -> tuple:
            began = time.perf_counter()
            try:
                reply = (call(request, timeout), 200, None, False)
            except JudgeError as error:
                reply = (None, error.status, str(error), error.retryable)
            except OSError as error:
                reply = (None, None, f"{type(error).__name__}: {error}", True)
            except Exception as error:  # a bug in the call must not cost the task its paid replies
                reply = (None, None, f"{type(error).__name__}: {error}", False)
            return (*reply, (time.perf_counter() - began) * 1000)

        def faulty(reply: str | None, n_items: int, names: list[str]) -> bool:
            """Whether the text of a reply lacks a key that it should have; what is answered is decided when it is parsed."""
            return reply is None or any(f'"item_{item}_{name}"' not in reply for item in range(1, n_items + 1) for name in names)

        def send(rows: pa.Table) -> pa.Table:
            replies = [one(request) for request in rows.column("request").to_pylist()]
            sets, names = rows.column("set_key").to_pylist(), {}
            for i, key in enumerate(sets):
                if key not in names:
                    names[key] = [q["name"] for q in rows.column("questions")[i].as_py()]
            lost = [r[2] is not None or faulty(r[0], n, names[key]) for r, n, key in zip(replies, rows.column("n_items").to_pylist(), sets)]
            # payloads are needed again after a refusal or a faulty reply, the request for another attempt only
            for name, needed in (("payloads", lost), ("request", [r[3] for r in replies])):
                at, old = rows.schema.get_field_index(name), rows.column(name)
                kept = [old[i].as_py() if needed[i] else None for i in range(len(replies))]
                rows = rows.set_column(at, name, pa.array(kept, old.type))
            for i, (name, kind) in enumerate(zip(_CALL_FIELDS.names, _CALL_TYPES)):
                rows = rows.append_column(name, pa.array([r[i] for r in replies], kind))
            return rows

        return send

    def reply(self, batches: DataFrame, cfg: JudgeConfig = JudgeConfig()) -> DataFrame:
        """The replies as a transformation: for folders that only Spark's writers reach. A lost task sends its batches again."""
        send = self._caller(cfg.timeout_seconds)

        def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in found:
                yield from send(pa.Table.from_batches([batch])).to_batches()

        return self._parsed(batches.mapInArrow(run, _called(batches)), batches.columns)

    def send(self, batches: DataFrame, cfg: JudgeConfig, folder: str) -> None:
        """Sends dealt batches in one job, each task committing every ``batches_per_task`` batches."""
        write_replies(batches, self._caller(cfg.timeout_seconds), folder, cfg.batches_per_task)

    def sent(self, batches: DataFrame, folder: str) -> DataFrame:
        """The replies in a folder of ``send``, those of a job that failed among them."""
        return self._parsed(batches.sparkSession.read.schema(_called(batches)).parquet(folder), batches.columns)

    @staticmethod
    def _parsed(called: DataFrame, columns: list[str]) -> DataFrame:
        called = called.withColumn("_reply", F.from_json("response", _REPLY))
        found, items = F.col("_reply.answers"), F.sequence(F.lit(1), F.col("n_items"))
        key = lambda item, q: F.concat(F.lit("item_"), item.cast("string"), F.lit("_"), q["name"])
        answers = F.transform(items, lambda item: F.transform("questions", lambda q: F.try_element_at(found, key(item, q))))
        expected = F.col("n_items") * F.size("questions")
        # an answer of null is an answer: what counts is that its key is there
        given = F.transform(items, lambda item: F.size(F.filter("questions", lambda q: F.map_contains_key(found, key(item, q)))))
        answered = F.aggregate(given, F.lit(0), lambda total, n: total + n)
        error = (F.when(F.col("call_error").isNotNull(), F.col("call_error"))
                 .when(found.isNull(), F.lit("the reply holds no answers object"))
                 .when(answered < expected, F.concat(answered.cast("string"), F.lit(" of "), expected.cast("string"),
                                                     F.lit(" questions were answered"))))
        zero = F.lit(0).cast("bigint")
        return (called.withColumn("answers", answers)
                .withColumn("error", error)
                .withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
                .withColumn("retryable", F.col("call_retryable"))
                .withColumn("input_tokens", F.coalesce("_reply.usage.input_tokens", zero))
                .withColumn("output_tokens", F.coalesce("_reply.usage.output_tokens", zero))
                .select(*columns, "answers", "status", "error", "retryable", "input_tokens",
                        "output_tokens", "api_ms"))
