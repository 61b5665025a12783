"""Several queries in one run: each unknown key is sent by one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flight_counts(requests: DataFrame, *, query: str = "query_id", owners: DataFrame | None = None) -> DataFrame:
    """Per query: rows in, keys it sends, keys it shares with the query that sends them, and
    deduplicated rows. ``requests`` has one row per (query, key), with ``n_rows``.

    The lowest query id that meets a key sends it. Counting needs no way back from a key to its
    queries: what a query does not send of its keys, it shares. So a key that every query asks
    about is combined on the map side like any other, and nothing joins on keys. ``owners`` (entry_key, query) are the senders where
    they are known.
    """
    seen = requests.groupBy(query).agg(F.sum("n_rows").alias("rows_in"), F.count(F.lit(1)).alias("_keys"))
    if owners is None:
        owners = requests.groupBy("entry_key").agg(F.min(query).alias(query))
    owned = owners.groupBy(query).agg(F.count(F.lit(1)).alias("_sent"))
    sent = F.coalesce("_sent", F.lit(0).cast("bigint"))
    return seen.join(owned, query, "left").select(
        query, "rows_in", sent.alias("rows_sent"), (F.col("_keys") - sent).alias("shared_in_flight"),
        (F.col("rows_in") - F.col("_keys")).alias("rows_deduped"))
