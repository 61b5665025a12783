import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rowjudge.functions import answers as A
from rowjudge.functions.payload import text_payload, value_payload
from rowjudge.judges.callable import CallableJudge, JudgeError
from rowjudge.judges.model import ModelJudge
from rowjudge.judges.rule import RuleJudge
from rowjudge.plans.patterns import quality_report
from rowjudge.plans.run import judge_rows
from rowjudge.questions import PROMPT_INTENT, make_question, single
from rowjudge.sources.answer_store import AnswerStore
from rowjudge.streaming.continuous import judged_stream
from tests.fake_judge import strict
from tests.oracle import TESTDATA


def test_a_fitted_model_as_judge(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    labelled = docs.join(spark.read.parquet(f"{TESTDATA}/sf0.001/labels.parquet"), "doc_id")
    stages = [RegexTokenizer(inputCol="payload", outputCol="words", pattern="[^a-z]+"),
              HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 10),
              LogisticRegression(labelCol="quality", maxIter=5)]
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    model = Pipeline(stages=stages).fit(labelled.where(half == 0).withColumn("payload", text_payload("text")))

    def transform(items):
        return model.transform(items).withColumn("probability", vector_to_array("probability")[1])

    judge, question = ModelJudge(transform), single(make_question("is the text of good quality?"))
    run = judge_rows(labelled, value_payload(labelled, "text"), question, judge)
    judged = run.rows.withColumn("p", A.number_field(F.col("answers")[0], "noul"))
    direct = model.transform(labelled.withColumn("payload", text_payload("text")))
    want = {r.doc_id: r.p for r in direct.select("doc_id", vector_to_array("probability")[1].alias("p")).collect()}
    got = {r.doc_id: r.p for r in judged.select("doc_id", "p").collect()}
    assert got == want
    report = quality_report(judged.select(F.col("p").alias("probability"), (F.col("quality") == 1).alias("expected"),
                                          F.lit(1).alias("tokens"), half.alias("part")), by=["part"]).collect()
    assert {r.part for r in report} == {0, 1} and all(0 <= r.accuracy <= 1 for r in report)


def test_a_model_refuses_other_questions(people):
    judge = ModelJudge(lambda items: items.withColumn("probability", F.lit(0.5)))
    run = judge_rows(people, value_payload(people, "note"), PROMPT_INTENT, judge, on_failure="keep")
    assert run.rows.where("answers IS NOT NULL").count() == 0


def test_needles(people):
    payload, judge = value_payload(people, "note"), RuleJudge({"q": "BANJO"})
    run = judge_rows(people, payload, single(make_question("anything")), judge)
    got = [r[0] for r in run.rows.orderBy("id").select(A.number_field(F.col("answers")[0], "noul")).collect()]
    assert got == [0.1, 0.9, 0.1]


def test_rows_judged_as_they_arrive(spark, tmp_path):
    source, out, store = str(tmp_path / "in"), str(tmp_path / "out"), AnswerStore(spark, str(tmp_path / "store"))
    question = single(make_question("the person paints murals"))

    def arrive(*texts):
        spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("t string").parquet(source)
        writer = judged_stream(stream, value_payload(stream, "t"), question, CallableJudge(strict), out, store=store)
        query = writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()

    arrive("paints murals", "plays banjo", "plays banjo")
    arrive("paints murals", "flies")
    rows = spark.read.parquet(out).select("batch_id", "t", A.number_field(F.col("answers")[0], "noul").alias("p"))
    assert sorted(map(tuple, rows.collect())) == [(0, "paints murals", 0.9), (0, "plays banjo", 0.1), (0, "plays banjo", 0.1),
                                                  (1, "flies", 0.1), (1, "paints murals", 0.9)]
    assert store.log().count() == 3  # murals was known when it came again


def test_payloads_of_faulty_replies_are_kept_and_requests_of_refused_batches_are_not():
    replies = {"good": '{"answers": {"item_1_p": {}, "item_2_p": {}}}', "half": '{"answers": {"item_1_p": {}}}'}

    def call(request: str, timeout: float) -> str:
        if request not in replies:
            raise JudgeError("refused", 422 if request == "bad" else 503)
        return replies[request]

    names = ["good", "half", "bad", "busy"]
    rows = pa.table({"set_key": ["k"] * 4, "n_items": [2] * 4, "payloads": [["1", "2"]] * 4, "questions": [[{"name": "p"}]] * 4, "request": names})
    told = CallableJudge(call)._caller(1.0)(rows)
    assert told.column("payloads").to_pylist() == [None, ["1", "2"], ["1", "2"], ["1", "2"]]
    assert told.column("request").to_pylist() == [None, None, None, "busy"]
