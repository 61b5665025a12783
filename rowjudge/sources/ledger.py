"""The run ledger: one row per run and query, one per batch attempt, one per dead letter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowjudge.sources import files

RUNS = ("run_id string, session_id string, seq bigint, query_id string, scope string, model string, rows_in bigint, "
        "rows_null bigint, rows_deduped bigint, cache_hits bigint, shared_in_flight bigint, rows_sent bigint, "
        "reclaimed bigint")
BATCHES = ("run_id string, batch_id string, attempt int, scope string, model string, set_key string, n_items int, "
           "status string, retryable boolean, error string, input_tokens bigint, output_tokens bigint, api_ms double")
DEAD_LETTERS = ("run_id string, scope string, model string, set_key string, entry_key string, payload string, "
                "error string")
_SCHEMAS = {"runs": RUNS, "batches": BATCHES, "dead_letters": DEAD_LETTERS}


def columns(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]


class Ledger:
    """Plain Parquet folders, one sub-folder per append, so a re-run of an append replaces its
    own rows and no others."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, kind: str, rows: DataFrame, name: str) -> None:
        rows.select(*columns(_SCHEMAS[kind])).write.mode("overwrite").parquet(f"{self.path}/{kind}/{name}")

    def _read(self, kind: str) -> DataFrame:
        folder = f"{self.path}/{kind}"
        if not files.list_dirs(self.spark, folder):
            return self.spark.createDataFrame([], _SCHEMAS[kind])
        return (self.spark.read.schema(_SCHEMAS[kind]).option("recursiveFileLookup", "true").parquet(folder))

    def runs(self) -> DataFrame:
        return self._read("runs")

    def batches(self) -> DataFrame:
        return self._read("batches")

    def dead_letters(self) -> DataFrame:
        return self._read("dead_letters")

    def next_seq(self) -> int:
        return len(files.list_dirs(self.spark, f"{self.path}/runs")) + 1
