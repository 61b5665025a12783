"""Fanning answers back out to rows, whatever the skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least this share of the rows. There are at most 1 / HOT_SHARE
# hot keys, and copies of their lookup rows come to at most twice that, whatever the size of the
# table: their list (a key and a number) may be broadcast.
HOT_SHARE = 1e-5
HOT_ROWS = 1_000


def hot_keys(counts: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """Keys of ``counts`` (``key``, ``n_rows``) with a share of at least HOT_SHARE, and in how
    many ``copies`` each is split so that no part holds more than that share. ``total`` is the
    sum of ``n_rows`` where it is known."""
    total = counts.agg(F.sum("n_rows")).scalar() if total is None else F.lit(total)
    floor = F.greatest(total * HOT_SHARE, F.lit(float(HOT_ROWS)))
    hot = counts.where((F.col("n_rows") >= floor) & F.col(key).isNotNull())
    return hot.select(key, F.ceil(F.col("n_rows") / floor).cast("int").alias("copies"))


def attach(rows: DataFrame, lookup: DataFrame, key: str, hot: DataFrame, salt: Column | None = None) -> DataFrame:
    """``rows`` left join ``lookup`` (unique per ``key``) with hot keys salted: rows of a hot
    key spread over its copies, and its single lookup row is repeated for each. ``salt`` is a
    number that differs among the rows of a key; without one, the map task a row comes from
    serves. Rows without a key never match, so they are spread too. Whether the join is a
    broadcast is left to Spark, which knows the sizes at run time."""
    marked = F.broadcast(hot.select(F.col(key).alias("_hot"), F.col("copies").alias("_copies")))
    part = F.spark_partition_id() if salt is None else salt
    spread = F.when(F.col(key).isNull(), part.cast("bigint")).when(
        F.col("_copies").isNotNull(), F.pmod(part.cast("bigint"), F.col("_copies"))).otherwise(F.lit(0))
    left = (rows.join(marked, F.col(key) == F.col("_hot"), "left")
            .withColumn("_salt", spread.cast("bigint")).drop("_hot", "_copies"))
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_copies", F.lit(1)).cast("bigint") - 1)
    right = (lookup.join(marked, F.col(key) == F.col("_hot"), "left")
             .withColumn("_salt", F.explode(copies)).drop("_hot", "_copies"))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
