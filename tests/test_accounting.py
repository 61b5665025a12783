from pyspark.sql import functions as F

from rowjudge.plans import accounting, patterns


def test_delta_between_phases(spark):
    df = spark.createDataFrame([(0, 5), (1, 8), (2, 8), (3, 11)], "phase int, n int")
    assert [r[1] for r in accounting.stats_delta(df, "n").orderBy("phase").collect()] == [None, 3, 0, 3]


def test_no_report_before_the_first_run(spark, tmp_path):
    from rowjudge.sources.ledger import Ledger
    ledger = Ledger(spark, str(tmp_path))
    assert accounting.last_report(ledger.runs(), ledger.batches(), "s").collect() == []
    stats = accounting.engine_stats(ledger.runs(), ledger.batches(), ledger.runs().select(F.lit("k").alias("entry_key")))
    assert (stats.first().requests, stats.first().cached_answers, stats.first().estimated_cost_usd) == (0, 0, 0.0)


def test_quality_margin(spark):
    df = spark.createDataFrame([(0.92, True, 100), (0.97, True, 140), (0.07, False, 120), (0.6, False, 120)],
                               "probability double, expected boolean, tokens int")
    row = patterns.quality_report(df).first()
    assert (row.n_rows, row.accuracy, row.caught, row.false_alarms) == (4, 0.75, 2, 1)
    assert (row.lowest_positive, row.highest_negative, row.tokens_per_row) == (0.92, 0.6, 120.0)


def test_suppressed_prompts_reach_no_consumer(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "p string, s boolean")
    assert [r.p for r in patterns.suppress(df, "p", F.col("s")).collect()] == [None, "b", "c"]


def test_the_flag_leads(spark):
    df = spark.createDataFrame([("work_related", 0.5), ("work_related", 0.4), (None, None)], "i string, m double")
    labels = [r[0] for r in df.select(patterns.leading_label(F.col("i"), F.col("m"))).collect()]
    assert labels == ["malicious", "work_related", None]


def test_sample_of_everything_is_exact(prompts):
    rows = patterns.sample_estimate(prompts, "user_prompt", 1000).collect()
    assert sum(r.share for r in rows) == 1.0 and {r.population for r in rows} == {30}
    assert sum(r.estimated_prompts for r in rows) == 30
