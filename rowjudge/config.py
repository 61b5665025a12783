"""Settings of a judging run.

Every setting can be given in code or through the Spark session
(``SET rowjudge.batch_size = 40``); values are clamped to their legal range once,
when the run starts, and stay fixed for that run.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import SparkSession

CONF_PREFIX = "rowjudge."

# Smallest legal value of each clamped setting.
_MINIMUM = {
    "batch_size": 1,
    "concurrency": 1,
    "max_retries": 1,
    "max_batch_tokens": 1,
    "timeout_seconds": 0.1,
    "rows_per_shard": 1,
    "batches_per_task": 1,
    "max_rows_per_run": 0,
    "max_payload_bytes_per_run": 0,
    "max_value_chars": 0,
    "store_max_entries": 0,
    "requests_per_minute": 0,
}


@dataclass(frozen=True)
class JudgeConfig:
    """Zero means "no limit" for the two run caps, ``max_value_chars``,
    ``store_max_entries`` and ``requests_per_minute``."""

    model: str = "rule-judge"
    threshold: float = 0.5
    batch_size: int = 25
    concurrency: int = 16
    timeout_seconds: float = 30.0
    max_retries: int = 6
    max_rows_per_run: int = 0
    max_payload_bytes_per_run: int = 0
    store_max_entries: int = 0
    max_value_chars: int = 0
    max_batch_tokens: int = 24_000
    requests_per_minute: int = 1_000
    # Spark-side sizing: distinct payloads that one packing group holds, and the
    # batches a dispatch task sends between two commits of its replies.
    rows_per_shard: int = 2_000
    batches_per_task: int = 500

    def __post_init__(self) -> None:
        for name, low in _MINIMUM.items():
            if getattr(self, name) < low:
                object.__setattr__(self, name, low)
        if not self.model:
            object.__setattr__(self, "model", type(self).model)

    def with_(self, **changes) -> "JudgeConfig":
        return replace(self, **changes)

    @classmethod
    def active(cls) -> "JudgeConfig":
        """The settings of the session at hand; the defaults where there is none."""
        spark = SparkSession.getActiveSession()
        return cls.from_conf(spark) if spark else cls()

    @classmethod
    def from_conf(cls, spark: SparkSession, **overrides) -> "JudgeConfig":
        """Read ``rowjudge.*`` from the session; keyword arguments win."""
        values = {}
        for f in fields(cls):
            text = spark.conf.get(CONF_PREFIX + f.name, None)
            if text is not None:
                kind = type(f.default)
                values[f.name] = kind(float(text)) if kind is int else kind(text)
        values.update(overrides)
        return cls(**values)
