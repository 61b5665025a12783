"""A judge that is a model the caller has trained, applied as a DataFrame transform.

``transform`` gets ``batch_id``, ``at`` and ``payload`` and adds ``probability``: the
``transform`` of a fitted ``pyspark.ml`` pipeline plus a projection is enough. It then answers
a yes/no question. One that adds ``probabilities`` (a map from label to probability) answers a
choice or a score: its labels must be among the question's options, options it does not know
have probability 0. A choice is the likeliest label, a score the mean position. Every question
of a set would get the same answer, so a set has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.judges.bayes import likeliest
from rowjudge.questions import CHOICE, NOUL, SCORE


def _choice_json(probabilities: Column) -> Column:
    best = likeliest(probabilities)
    return F.to_json(F.struct(F.lit(CHOICE).alias("type"), best["label"].alias("choice"), probabilities.alias("probabilities"),
                              best["probability"].alias("confidence")))


def _score_json(probabilities: Column, options: Column) -> Column:
    levels = F.transform(options, lambda _, i: i.cast("string"))
    shares = F.transform(options, lambda o: F.coalesce(F.get(F.map_values(F.map_filter(probabilities, lambda k, _: k == o)), F.lit(0)), F.lit(0.0)))
    mean = F.aggregate(F.transform(shares, lambda p, i: p * i), F.lit(0.0), lambda a, x: a + x)
    return F.to_json(F.struct(F.lit(SCORE).alias("type"), mean.alias("score"), F.map_from_arrays(levels, options).alias("legend"),
                              F.map_from_arrays(levels, shares).alias("probabilities"), F.array_max(shares).alias("confidence")))


class ModelJudge:
    def __init__(self, transform: Callable[[DataFrame], DataFrame]):
        self.transform = transform

    def require_ready(self) -> None:
        """A fitted model is ready."""

    def reply(self, batches: DataFrame, cfg: JudgeConfig = JudgeConfig()) -> DataFrame:
        items = batches.select("batch_id", F.posexplode("payloads").alias("at", "payload"))
        scored = self.transform(items)
        labels = "probabilities" in scored.columns
        # as entries, since maps have no order to sort by
        said = F.map_entries("probabilities") if labels else F.col("probability").cast("double")
        scored = scored.select("batch_id", "at", said.alias("said"))
        # a batch holds batch_size items at the most
        told = scored.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("at", "said"))).alias("_told"))
        kind, options = F.col("questions")[0]["kind"], F.col("questions")[0]["options"]
        if labels:
            def answer(said: Column) -> Column:
                shares = F.map_from_entries(said)
                return F.when(kind == SCORE, _score_json(shares, options)).otherwise(_choice_json(shares))

            foreign = F.exists("_told", lambda item: F.size(F.array_except(F.transform(item["said"], lambda e: e["key"]), options)) > 0)
            suits, asks = kind.isin(CHOICE, SCORE), "choice or score"
        else:
            def answer(said: Column) -> Column:
                return F.to_json(F.struct(F.lit(NOUL).alias("type"), said.alias("noul")))

            foreign = F.lit(False)
            suits, asks = kind == NOUL, "yes/no question"
        answers = F.transform("_told", lambda item: F.array(answer(item["said"])))
        complete = (F.size("_told") == F.size("payloads")) & ~F.exists("_told", lambda item: item["said"].isNull())
        error = (F.when((F.size("questions") != 1) | ~suits, F.lit(f"a model answers one {asks}"))
                 .when(~F.coalesce(complete, F.lit(False)), F.lit("the model left rows without a probability"))
                 .when(foreign, F.lit("the model knows labels that the question lacks")))
        return (batches.join(told, "batch_id", "left")
                .withColumn("answers", answers)
                .withColumn("error", error)
                .withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed"))
                .withColumn("retryable", F.lit(False))
                .withColumn("input_tokens", F.lit(0).cast("bigint"))
                .withColumn("output_tokens", F.lit(0).cast("bigint"))
                .withColumn("api_ms", F.lit(0.0))
                .drop("_told"))
