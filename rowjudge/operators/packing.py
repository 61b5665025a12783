"""Packing distinct requests into batches.

A batch is cut in key order inside a shard, closes at ``batch_size`` items or before its
estimated tokens would pass the budget, and never crosses a group (scope and question set).
Shards are hash buckets of the key, so they are even and need no global order; each holds
about ``rows_per_shard`` requests, which bounds the array the greedy cut runs over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.operators.keys import key_bucket

# Payload bytes one shard may hold on average, where payloads are large.
SHARD_BYTES = 32 << 20
# Payload bytes a partition of dealt shards may hold, and the shards it needs to be even.
PART_BYTES, PART_SHARDS = 128 << 20, 4
# Up to this many groups beyond one shard, their counts (a short row each) are broadcast.
BROADCAST_GROUPS = 100_000
# Beyond that a group, which may hold a third of the requests, meets its count in SALTS parts.
SALTS = 256


def shards_of(rows: int, payload_bytes: int, cfg: JudgeConfig) -> int:
    """Shards of one group whose size is known."""
    return max(1, -(-rows // cfg.rows_per_shard), -(-payload_bytes // SHARD_BYTES))


def dealt_shards(shards: int, payload_bytes: int, cfg: JudgeConfig) -> int | None:
    """Partitions that shards of one group go to so that each of ``concurrency`` tasks takes as many of them; None where shards are too
    few to be dealt whole."""
    parts = cfg.concurrency * max(1, -(-payload_bytes // (cfg.concurrency * PART_BYTES)))
    return parts if shards >= PART_SHARDS * parts else None


def large_groups(misses: DataFrame, group: Sequence[str], cfg: JudgeConfig) -> DataFrame:
    """Groups that need more than one shard, with their number of shards."""
    by_rows = F.ceil(F.count(F.lit(1)) / cfg.rows_per_shard)
    by_bytes = F.ceil(F.sum(F.octet_length("payload").cast("bigint")) / SHARD_BYTES)
    counts = misses.groupBy(*group).agg(F.greatest(by_rows, by_bytes).cast("bigint").alias("_shards"))
    return counts.where(F.col("_shards") > 1)


def assign_shards(misses: DataFrame, group: Sequence[str], cfg: JudgeConfig, *, shards: int | None = None,
                  few: DataFrame | None = None) -> DataFrame:
    """Add ``shard``. ``shards`` is the number for a single group of known size; ``few`` are the
    large groups where they have been counted and are no more than BROADCAST_GROUPS."""
    if shards is not None:
        return misses.withColumn("shard", key_bucket(F.col("entry_key"), shards))
    if few is not None:
        joined = misses.join(F.broadcast(few), list(group), "left")
    else:
        large = large_groups(misses, group, cfg).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = misses.withColumn("_salt", key_bucket(F.substring("entry_key", 9, 8), SALTS))
        joined = salted.join(large, [*group, "_salt"], "left").drop("_salt")
    number = F.coalesce(F.col("_shards"), F.lit(1))
    return joined.withColumn("shard", key_bucket(F.col("entry_key"), number)).drop("_shards")


def _batch_starts(entries: Column, fixed: Column, row: Column, cfg: JudgeConfig) -> Column:
    """Positions at which a batch begins: a left fold, since each cut depends on the last."""
    start = F.struct(
        F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("tokens"), F.lit(0).alias("at"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(acc: Column, entry: Column) -> Column:
        cost = entry["tokens"] + row
        full = (acc["n"] == cfg.batch_size) | (acc["tokens"] + cost > cfg.max_batch_tokens)
        fresh = (acc["n"] == 0) | full
        return F.struct(
            F.when(fresh, F.lit(1)).otherwise(acc["n"] + 1).alias("n"),
            (F.when(fresh, fixed).otherwise(acc["tokens"]) + cost).cast("bigint").alias("tokens"),
            (acc["at"] + 1).alias("at"),
            F.when(fresh, F.concat(acc["starts"], F.array(acc["at"]))).otherwise(acc["starts"]).alias("starts"),
        )

    return F.aggregate(entries, start, step, lambda acc: acc["starts"])


def pack(misses: DataFrame, cfg: JudgeConfig, *, group: Sequence[str] = ("scope", "set_key"),
         carry: Sequence[Column] = (), fixed: Column | int = 0, row: Column | int = 0, shards: int | None = None,
         few: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """``misses`` (the group, entry_key, payload, tokens) to one row per batch: the group, shard,
    batch_no, and ``items`` of (entry_key, tokens, payload). ``carry`` are aggregates to keep;
    ``shards`` and ``few`` as in :func:`assign_shards`; ``parts`` partitions hold whole shards, where given."""
    fixed = fixed if isinstance(fixed, Column) else F.lit(fixed).cast("bigint")
    row = row if isinstance(row, Column) else F.lit(row).cast("bigint")
    entry = F.struct("entry_key", "tokens", "payload")
    assigned = assign_shards(misses, group, cfg, shards=shards, few=few)
    if parts is not None:
        assigned = assigned.repartition(parts, *group, "shard")
    sharded = (assigned.groupBy(*group, "shard")
               .agg(F.sort_array(F.collect_list(entry)).alias("_entries"), *carry))
    cut = sharded.withColumn("_starts", _batch_starts(F.col("_entries"), fixed, row, cfg))
    stops = F.concat(F.slice("_starts", F.lit(2), F.size("_starts")), F.array(F.size("_entries")))
    slices = F.zip_with(F.col("_starts"), stops, lambda a, b: F.slice(F.col("_entries"), a + 1, b - a))
    return (cut.select("*", F.posexplode(slices).alias("batch_no", "items"))
            .drop("_entries", "_starts"))
