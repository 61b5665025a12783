"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TESTDATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{sf}/{name}.parquet'")
    return con


def _sorted(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    names = sorted(df.columns)
    ours = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    want = _sorted(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    got = _sorted(df.select(*names).collect())
    if len(got) != len(want):
        return f"rows: {len(got)} here, {len(want)} in SQL"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"values: {len(wrong)} differ, first {wrong[0]}" if wrong else None


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("rowjudge")
             .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf: str, *names: str) -> None:
    from __spark_entry__ import oracle_sql, queries
    spark, con, sql = session(), duck(sf), oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        began = time.perf_counter()
        try:
            df = run(spark, f"{TESTDATA}/{sf}")
            found = differences(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # report every query, whatever breaks one
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:32s} {time.perf_counter() - began:6.2f}s  {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
