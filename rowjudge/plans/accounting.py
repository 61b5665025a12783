"""Reports over the run ledger: what was asked, answered, shared and paid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowjudge.operators.guards import cost_usd

# Counters of a run, and of its batch attempts.
ROW_COUNTERS = ("rows_in", "rows_null", "rows_deduped", "cache_hits", "shared_in_flight", "rows_sent", "reclaimed")
SPEND_COUNTERS = ("requests", "retries", "input_tokens", "output_tokens")


def spend(batches: DataFrame, *by: str) -> DataFrame:
    """Answered requests, failed attempts, tokens and cost of batch attempts."""
    ok = F.col("status") == "ok"
    return batches.groupBy(*by).agg(
        F.count_if(ok).alias("requests"),
        F.count_if(~ok).alias("retries"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("bigint").alias("output_tokens"),
    ).withColumn("estimated_cost_usd", cost_usd(F.col("input_tokens")))


def run_report(runs: DataFrame, batches: DataFrame) -> DataFrame:
    """One row per run: its row counters (over its queries) and its spend."""
    counted = runs.groupBy("run_id", "session_id", "seq").agg(*[F.sum(c).alias(c) for c in ROW_COUNTERS])
    return (counted.join(spend(batches, "run_id"), "run_id", "left")
            .na.fill(0, list(SPEND_COUNTERS)).na.fill(0.0, ["estimated_cost_usd"]))


def last_report(runs: DataFrame, batches: DataFrame, session_id: str) -> DataFrame:
    """The report of the session's last run; no row before its first."""
    mine = runs.where(F.col("session_id") == session_id)
    newest = mine.agg(F.max("seq")).scalar()
    last = mine.where(F.col("seq") == newest)
    return run_report(last, batches.join(last.select("run_id").distinct(), "run_id", "left_semi"))


def engine_stats(runs: DataFrame, batches: DataFrame, answers: DataFrame) -> DataFrame:
    """Everything so far, in one row. ``answers`` is the answer store's latest view."""
    rows = runs.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                      for c in ("cache_hits", "shared_in_flight", "reclaimed")])
    paid = spend(batches)
    ok = F.col("status") == "ok"
    work = batches.agg(F.coalesce(F.sum(F.when(ok, F.col("n_items"))), F.lit(0)).cast("bigint").alias("rows_evaluated"),
                       F.coalesce(F.sum("api_ms"), F.lit(0.0)).alias("api_ms"),
                       F.count_if(F.col("error").isNotNull()).alias("errors"))
    kept = answers.agg(F.count(F.lit(1)).alias("cached_answers"))
    # each part is one row: one becomes the frame, the others scalar subqueries of it
    rows, paid, kept = (part.select(F.struct("*")).scalar() for part in (rows, paid, kept))
    return (work.select("*", rows.alias("_r"), paid.alias("_p"), kept.alias("_k"))
            .select("_r.*", "_p.*", "rows_evaluated", "api_ms", "errors", "_k.*"))


def stats_delta(snapshots: DataFrame, counter: str, *, phase: str = "phase") -> DataFrame:
    """Growth of a counter since the phase before, a row for each phase there is (one per run, so one task orders them)."""
    before = F.lag(counter).over(Window.orderBy(phase))
    return snapshots.select(phase, (F.col(counter) - before).alias(f"{counter}_since"))


def scope_spend(batches: DataFrame) -> DataFrame:
    """Spend per scope and model, with subtotals per scope and a grand total."""
    ok = F.col("status") == "ok"
    return batches.rollup("scope", "model").agg(
        F.count_if(ok).alias("requests"),
        F.sum(F.when(ok, F.col("n_items")).otherwise(0)).cast("bigint").alias("rows_sent"),
        F.sum("input_tokens").cast("bigint").alias("input_tokens"),
    ).withColumn("estimated_cost_usd", cost_usd(F.col("input_tokens")))
