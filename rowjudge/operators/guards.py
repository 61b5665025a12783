"""Spend guards and the dispatch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig

# Fixed value: list price in USD of a million input tokens; output is free.
USD_PER_MILLION_TOKENS = 0.042


class CapExceeded(RuntimeError):
    """A run that would send more than it is allowed to; raised before anything is sent."""


def check_caps(cfg: JudgeConfig, rows: int, payload_bytes: int) -> None:
    if 0 < cfg.max_rows_per_run < rows:
        raise CapExceeded(f"{rows} rows to send are more than max_rows_per_run = {cfg.max_rows_per_run}")
    if 0 < cfg.max_payload_bytes_per_run < payload_bytes:
        raise CapExceeded(f"{payload_bytes} payload bytes to send are more than "
                          f"max_payload_bytes_per_run = {cfg.max_payload_bytes_per_run}")


def cost_usd(tokens):
    return tokens * F.lit(USD_PER_MILLION_TOKENS) / F.lit(1_000_000.0)


def would_send(misses: DataFrame, *group: str) -> DataFrame:
    """Rows and payload bytes a run would send, per group."""
    return misses.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("payload").cast("bigint")).alias("payload_bytes"),
    )


def dispatch_plan(batches: DataFrame, cfg: JudgeConfig, *, fixed: int, row: int) -> DataFrame:
    """Requests, floor time at the rate limit, estimated tokens and cost of packed batches."""
    tokens = F.sum(F.lit(fixed) + F.aggregate(
        "items", F.lit(0).cast("bigint"), lambda acc, item: (acc + item["tokens"] + F.lit(row)).cast("bigint")))
    plan = batches.agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum(F.size("items")).cast("bigint").alias("rows"),
        F.coalesce(tokens, F.lit(0)).cast("bigint").alias("estimated_tokens"),
    )
    floor = F.col("requests") * 60.0 / cfg.requests_per_minute if cfg.requests_per_minute else F.lit(0.0)
    return plan.withColumn("floor_seconds", floor).withColumn("estimated_usd", cost_usd(F.col("estimated_tokens")))
