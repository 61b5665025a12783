import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from rowjudge.functions.payload import estimate_tokens, row_payload, text_payload, value_payload


def test_whole_row_subset_and_scalar(people):
    ada = people.where("id = 1")
    assert ada.select(row_payload(ada)).first()[0] == '{"id":1,"name":"Ina","note":"builds sailboats"}'
    assert ada.select(row_payload(ada, ["name"])).first()[0] == '{"name":"Ina"}'
    assert ada.select(value_payload(ada, "name")).first()[0] == '"Ina"'
    assert ada.select(value_payload(ada, "id")).first()[0] == "1"


def test_types(spark):
    df = spark.sql("""SELECT CAST(NULL AS INT) AS nothing, true AS flag, CAST(1.5 AS DECIMAL(5,2)) AS price,
        double('NaN') AS nan, double('-Infinity') AS inf, 0.5D AS half, X'FF00' AS raw, DATE '2024-02-03' AS day,
        TIMESTAMP_NTZ '2024-02-03 04:05:06' AS at, INTERVAL '1' DAY AS span, map(1, 'abcdef') AS m,
        array('abcdef', NULL) AS l, named_struct('deep', array(named_struct('s', 'abcdef'))) AS nest,
        CAST(12345678901234567890 AS DECIMAL(38,0)) AS huge""")
    text = df.select(row_payload(df, max_value_chars=3)).first()[0]
    assert text == ('{"nothing":null,"flag":true,"price":1.50,"nan":null,"inf":null,"half":0.5,"raw":"/wA=",'
                    '"day":"2024-02-03","at":"2024-02-03 04:05:06","span":"INTERVAL \'1\' DAY","m":{"1":"abc"},'
                    '"l":["abc",null],"nest":{"deep":[{"s":"abc"}]},"huge":12345678901234567890}')


def test_map_keys_are_not_cut_and_null_structs_stay_null(spark):
    df = spark.sql("SELECT map('abcdef', 'abcdef') AS m, CAST(NULL AS STRUCT<s: STRING>) AS s, map(DATE '2024-01-02', 1) AS d")
    assert df.select(row_payload(df, max_value_chars=2)).first()[0] == '{"m":{"abcdef":"ab"},"s":null,"d":{"2024-01-02":1}}'
    assert df.select(value_payload(df, "s")).first()[0] is None


def test_non_finite_scalar_is_sent_as_null(spark):
    df = spark.createDataFrame([(math.nan,), (1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(value_payload(df, "x")).collect()] == ["null", "1.5", None]


def test_cut_is_in_code_points(spark):
    df = spark.createDataFrame([("é😀" * 3000,)], "t string")
    assert len(json.loads(df.select(value_payload(df, "t")).first()[0])) == 6000
    assert len(json.loads(df.select(value_payload(df, "t", max_value_chars=10)).first()[0])) == 10
    assert len(json.loads(df.select(value_payload(df, "t", max_value_chars=0)).first()[0])) == 6000


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_payload_reads_back_and_tokens_match_a_byte_loop(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, payload, tokens in df.select("t", text_payload("t"), estimate_tokens("t")).collect():
        assert json.loads(payload) == text
        raw = text.encode()
        narrow = sum(b < 0x80 for b in raw)
        two = sum(b & 0xE0 == 0xC0 for b in raw)
        wide = sum(b & 0xF0 == 0xE0 or b & 0xF8 == 0xF0 for b in raw)
        assert tokens == (narrow + 2) // 3 + two + 2 * wide


def test_only_the_judged_columns_are_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = docs.select(row_payload(docs, ["doc_id", "lang"]).alias("p"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_session_setting_cuts_texts(spark):
    df = spark.createDataFrame([("x" * 6000,)], "t string")
    spark.conf.set("rowjudge.max_value_chars", "7")
    try:
        assert len(json.loads(df.select(value_payload(df, "t")).first()[0])) == 7
        assert len(json.loads(df.select(text_payload("t")).first()[0])) == 7
        assert len(json.loads(df.select(row_payload(df)).first()[0])["t"]) == 7
    finally:
        spark.conf.unset("rowjudge.max_value_chars")


def test_variant_and_time(spark):
    df = spark.sql("""SELECT parse_json('{"a":{"b":1}}') AS v, parse_json('3') AS n, TIME'10:20:30' AS t""")
    assert df.select(value_payload(df, "v")).first()[0] == '{"a":{"b":1}}'
    assert df.select(value_payload(df, "n")).first()[0] == "3"
    assert df.select(value_payload(df, "t")).first()[0] == '"10:20:30"'
    assert json.loads(df.select(row_payload(df)).first()[0]) == {"v": {"a": {"b": 1}}, "n": 3, "t": "10:20:30"}
