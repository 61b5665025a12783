"""The query shapes that judging is used in, as functions of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.functions.judging import RULES, with_prompt_intent
from rowjudge.functions.payload import estimate_tokens
from rowjudge.judges.rule import RuleJudge
from rowjudge.operators.lookup import attach, hot_keys

# The malicious threshold and the normal quantile of a 95 % interval.
MALICIOUS_AT = 0.5
Z_95 = 1.96


def suppress(df: DataFrame, prompt: str, suppressed: Column) -> DataFrame:
    """NULL the prompt of flagged rows ahead of every consumer."""
    return df.withColumn(prompt, F.when(~F.coalesce(suppressed, F.lit(False)), F.col(prompt)))


def leading_label(intent: Column, malicious: Column, threshold: float = MALICIOUS_AT) -> Column:
    """A malicious prompt's intent means nothing, so the flag leads."""
    return F.when(malicious >= threshold, F.lit("malicious")).otherwise(intent)


def prompt_breakdown(df: DataFrame, prompt: str, *, by: Sequence[str] = (), judge: RuleJudge = RULES) -> DataFrame:
    """Distinct prompts per intent, and how many of them are malicious."""
    distinct = df.where(F.col(prompt).isNotNull()).select(*by, prompt).distinct()
    judged = with_prompt_intent(distinct, prompt, judge=judge)
    return judged.groupBy(*by, F.col("r.intent").alias("intent")).agg(
        F.count(F.lit(1)).alias("prompts"),
        F.count_if(F.col("r.malicious_probability") >= MALICIOUS_AT).alias("malicious"),
    )


def breakdown_of_rows(df: DataFrame, prompt: str, *, by: Sequence[str] = (), judge: RuleJudge = RULES) -> DataFrame:
    """Classify distinct prompts, join back, count all rows. Rows are first counted per
    (``by``, prompt), so a prompt that fills a third of the table joins as one row per group; a
    prompt that many groups share is salted by group. The join and its list of hot keys hold digests, never a prompt's text."""
    counted = df.where(F.col(prompt).isNotNull()).groupBy(*by, prompt).agg(F.count(F.lit(1)).alias("n_rows"))
    counted = counted.withColumn("_digest", F.sha2(F.col(prompt), 256))
    distinct = counted.groupBy("_digest").agg(F.first(prompt).alias(prompt), F.count(F.lit(1)).alias("n_rows"))
    label = leading_label(F.col("r.intent"), F.col("r.malicious_probability"))
    judged = with_prompt_intent(distinct, prompt, judge=judge).select("_digest", label.alias("label"))
    groups = F.xxhash64(*by) if by else F.lit(0)
    joined = attach(counted.drop(prompt), judged, "_digest", hot_keys(distinct, "_digest"), salt=groups)
    return joined.groupBy(*by, "label").agg(F.sum("n_rows").alias("n_rows"),
                                                         F.count(F.lit(1)).alias("prompts"))


def sample_estimate(df: DataFrame, prompt: str, n: int, *, judge: RuleJudge = RULES) -> DataFrame:
    """Classify the ``n`` distinct prompts of lowest hash and scale up: per label the share with
    its 95 % half-width, and the estimated number of distinct prompts. The same question always
    draws the same sample."""
    distinct = df.where(F.col(prompt).isNotNull()).select(prompt).distinct()
    sample = distinct.orderBy(F.md5(F.col(prompt)), prompt).limit(n)
    judged = with_prompt_intent(sample, prompt, judge=judge)
    label = leading_label(F.col("r.intent"), F.col("r.malicious_probability"))
    shares = judged.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("sampled"))
    population = distinct.agg(F.count(F.lit(1))).scalar()
    share = F.col("sampled") / F.least(F.lit(n), F.col("population"))
    return (shares.withColumn("population", population)
            .withColumn("share", share)
            .withColumn("half_width", F.lit(Z_95) * F.sqrt(
                F.col("share") * (1 - F.col("share")) / F.least(F.lit(n), F.col("population"))))
            .withColumn("estimated_prompts", F.round(F.col("share") * F.col("population")).cast("bigint")))


def top_by_probability(df: DataFrame, probability: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.col(probability).desc(), tie).limit(k)


def quality_report(judged: DataFrame, *, probability: str = "probability", expected: str = "expected",
                   tokens: str = "tokens", by: Sequence[str] = (), threshold: float = MALICIOUS_AT) -> DataFrame:
    """Yes/no answers against known labels: accuracy, positives caught, false alarms, the margin
    (lowest positive, highest negative) and tokens per row; per judge when ``by`` names it."""
    said, yes = F.col(probability) >= threshold, F.col(expected)
    return judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_if(said == yes) / F.count(F.lit(1))).alias("accuracy"),
        F.count_if(yes).alias("positives"),
        F.count_if(said & yes).alias("caught"),
        F.count_if(said & ~yes).alias("false_alarms"),
        F.min(F.when(yes, F.col(probability))).alias("lowest_positive"),
        F.max(F.when(~yes, F.col(probability))).alias("highest_negative"),
        (F.sum(tokens) / F.count(F.lit(1))).alias("tokens_per_row"),
    )


def judged_by_each(df: DataFrame, payload: str, judges: Mapping[str, Column], row_tokens: int = 0) -> DataFrame:
    """One row per (row, judge) with its probability, from a single pass over the payload."""
    answers = F.array(*[F.struct(F.lit(name).alias("judge"), p.alias("probability")) for name, p in judges.items()])
    exploded = df.withColumn("tokens", estimate_tokens(payload) + row_tokens).withColumn("_a", F.explode(answers))
    return exploded.select("*", "_a.judge", "_a.probability").drop("_a", payload)
