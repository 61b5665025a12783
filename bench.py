"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowjudge.config import JudgeConfig
from rowjudge.functions.payload import value_payload
from rowjudge.judges.callable import CallableJudge
from rowjudge.plans.run import judge_rows
from rowjudge.queries import QUERIES
from rowjudge.queries.runs import answer_all
from rowjudge.questions import PROMPT_INTENT
from rowjudge.sources.answer_store import AnswerStore
from rowjudge.sources.files import scratch_dir
from rowjudge.sources.tables import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = ("prompt_intent_breakdown", "prompt_intent_by_user", "prompt_intent_joinback", "judge_prob", "semantic_filter",
            "ask_multi", "payload_typed", "token_estimate", "pack_tokens", "dispatch_plan", "cache_split", "single_flight",
            "store_evict", "run_report", "judge_comparison", "sample_estimate", "judged_run")


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("rowjudge-bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialise(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def prompt_runs(spark: SparkSession) -> tuple[dict[str, float], dict]:
    """All distinct user prompts through a batch judge, then the same again: all from the store.
    The judge is a local function, so this is the engine's own time."""
    prompts = table(spark, SF_DIR, "conversations").where(F.col("role") == "user")
    store = AnswerStore(spark, tempfile.mkdtemp(prefix="bench-", dir=scratch_base(spark)) + "/store")
    reports = []

    def run() -> None:
        judged = judge_rows(prompts, value_payload(prompts, "text"), PROMPT_INTENT, CallableJudge(answer_all),
                            store=store, cfg=JudgeConfig())
        materialise(judged.rows)
        reports.append(judged.report)

    seconds = {"prompts_first_run": timed(run), "prompts_second_run": timed(run)}
    first, second = reports
    facts = {
        "rows_in": first["rows_in"], "rows_sent": first["rows_sent"], "requests": first["requests"],
        "requests_per_1000": round(1000 * first["requests"] / max(first["rows_sent"], 1), 1),
        "input_tokens_per_prompt": round(first["input_tokens"] / max(first["rows_sent"], 1), 1),
        "second_run_sent": second["rows_sent"], "second_run_hits": second["cache_hits"],
    }
    return seconds, facts


def scratch_base(spark: SparkSession) -> str:
    base = scratch_dir(spark)
    os.makedirs(base, exist_ok=True)
    return base


def main() -> None:
    spark = session()
    materialise(QUERIES["prompt_intent_breakdown"].run(spark, SF_DIR))  # start the JVM's engines once
    seconds = {name: timed(lambda name=name: materialise(QUERIES[name].run(spark, SF_DIR))) for name in HEADLINE}
    runs, facts = prompt_runs(spark)
    seconds.update(runs)
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1], "facts": facts}))
    spark.stop()


if __name__ == "__main__":
    main()
