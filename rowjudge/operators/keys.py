"""What makes two requests the same: scope, model, questions and payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\u001f"


def _sized(text: Column) -> Column:
    # length first, so that no text can run into its neighbour
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)


def entry_key(scope: Column, model: Column, set_key: Column, payload: Column) -> Column:
    """SHA-256 over the four parts. An unset scope is a namespace of its own (the empty one);
    a NULL payload has no key."""
    scope = F.coalesce(scope.cast("string"), F.lit(""))
    whole = F.concat(_sized(scope), F.lit(UNIT), _sized(model), F.lit(UNIT), set_key, F.lit(UNIT), payload)
    return F.sha2(whole, 256)


def key_bucket(key: Column, buckets: Column | int) -> Column:
    """A bucket of a hexadecimal key: even, and the same in every run."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int")
