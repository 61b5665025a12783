"""Deduplication of requests and the split into known and unknown answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.operators.keys import entry_key


def distinct_requests(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per distinct request with ``n_rows``, the input rows it stands for.

    Grouping on the plain columns lets the map side combine in a hash aggregate, so a payload
    that fills a third of the table leaves each map task as one row.
    """
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))


def with_entry_key(requests: DataFrame, model: str, set_key: Column, *, scope: str = "scope",
                   payload: str = "payload") -> DataFrame:
    return requests.withColumn("entry_key", entry_key(F.col(scope), F.lit(model), set_key, F.col(payload)))


def split_fates(requests: DataFrame, known: DataFrame | None) -> DataFrame:
    """Add ``answers`` and ``fate``: ``null`` (nothing to ask), ``hit`` (``known`` holds the
    answer) or ``miss``. Both sides are unique per key; requests without a key probe with a text
    of their scope, which no key equals, so that they do not meet in one partition. Without
    ``known`` there is nothing to join."""
    if known is None:
        nothing = requests.withColumn("answers", F.lit(None).cast("array<string>"))
        return nothing.withColumn("fate", F.when(F.col("entry_key").isNull(), "null").otherwise("miss"))
    found = known.select(F.col("entry_key").alias("_known"), "answers")
    probe = F.coalesce("entry_key", F.concat(F.lit("none:"), F.col("scope")))
    fate = (F.when(F.col("entry_key").isNull(), "null")
            .when(F.col("_known").isNotNull(), "hit").otherwise("miss"))
    joined = requests.withColumn("_probe", probe).join(found, F.col("_probe") == F.col("_known"), "left")
    return joined.withColumn("fate", fate).drop("_probe", "_known")
