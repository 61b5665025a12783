"""Named queries, each with the SQL that must give the same rows (where SQL can say it)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


# -- pieces of oracle SQL -------------------------------------------------------------------

PROMPT_SQL = "concat('please ', event_type, ' ', props)"


def payload_sql(text: str, limit: int = 0) -> str:
    return f"CAST(to_json({f'substring({text}, 1, {limit})' if limit else text}) AS VARCHAR)"


def noul_sql(payload: str, needle: str) -> str:
    return f"CASE WHEN {payload} IS NULL THEN NULL WHEN contains(lower({payload}), '{needle}') " \
           f"THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END"


def pick_sql(payload: str, options: list[str]) -> str:
    labels = ", ".join(f"'{o}'" for o in options)
    return f"([{labels}])[CAST(length({payload}) % {len(options)} AS INTEGER) + 1]"


def intent_sql(payload: str) -> str:
    return pick_sql(payload, ["work_related", "personal", "other"])
