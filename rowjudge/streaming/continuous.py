"""Judging rows as they arrive: every micro-batch is a run against the same store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rowjudge.plans.run import judge_rows
from rowjudge.questions import QuestionSet


def judged_stream(stream: DataFrame, payload: Column, questions: QuestionSet | Column, judge, path: str,
                  **options) -> DataStreamWriter:
    """A writer, to be given a checkpoint and a trigger and started. Judged rows go to
    ``<path>/batch_id=<n>``; a micro-batch that is repeated after a failure replaces its own
    folder, and finds in the ``store`` of ``options`` what it has paid for already."""

    def judge_batch(rows: DataFrame, batch_id: int) -> None:
        if rows.isEmpty():
            return
        run = judge_rows(rows, payload, questions, judge, **options)
        stamped = run.rows.withColumn("run_id", F.lit(run.run_id))
        stamped.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        run.discard()

    return stream.writeStream.foreachBatch(judge_batch)
