"""Question sets as data.

Inside a run every request carries its question set as one struct column: a literal when
all rows are asked the same, compiled from the text when each row brings its own. That
keeps differing sets in one flow, with nothing to look up and nothing to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowjudge.operators.requests import request_size
from rowjudge.questions import QuestionError, QuestionSet, compact_json, parse_questions

_TEXTS = T.ArrayType(T.StringType())
_QUESTION_TYPE = (
    T.StructType().add("name", "string").add("kind", "string").add("query", "string").add("options", _TEXTS)
    .add("needle", "string")
)
SET_TYPE = (
    T.StructType().add("set_key", "string").add("rubric", "string").add("templates", _TEXTS)
    .add("questions", T.ArrayType(_QUESTION_TYPE)).add("fixed_tokens", "long").add("row_tokens", "long")
    .add("error", "string")
)


def describe(chosen: QuestionSet, model: str) -> dict:
    fixed, per_row = request_size(model, chosen)
    return {
        "set_key": chosen.set_key,
        "rubric": chosen.rubric_json,
        "templates": list(chosen.item_templates),
        "questions": [
            {"name": q.name, "kind": q.kind, "query": q.query, "options": list(q.options), "needle": q.needle}
            for q in chosen.questions
        ],
        "fixed_tokens": fixed,
        "row_tokens": per_row,
        "error": None,
    }


def literal_set(chosen: QuestionSet, model: str) -> Column:
    """One constant, folded by the optimizer."""
    return F.from_json(F.lit(compact_json(describe(chosen, model))), SET_TYPE)


def question_compiler(model: str):
    """A pandas UDF: question-set text to SET_TYPE, with the ``error`` of one that is refused."""
    nothing = dict.fromkeys(SET_TYPE.names)

    def one(text: str | None) -> dict:
        if text is None:
            return nothing
        try:
            return describe(parse_questions(text), model)
        except QuestionError as error:
            return {**nothing, "error": str(error)}

    @F.pandas_udf(SET_TYPE)
    def compile_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            # one parse per distinct text of a batch
            told = {text: one(text) for text in texts.unique()}
            yield pd.DataFrame([told[text] for text in texts], columns=SET_TYPE.names)

    return compile_texts


def compile_question_column(requests: DataFrame, question: str, model: str, *, into: str = "qset") -> DataFrame:
    """Validate a column of question-set texts, each distinct text once: the table meets Python nowhere, and joins the
    compiled sets on a digest of the text. A text that is refused stops the query."""
    texts = requests.select(F.col(question).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    compiled = texts.withColumn("_compiled", question_compiler(model)(F.col("_text")))
    refused = F.raise_error(F.col("_compiled.error")).cast(SET_TYPE)
    checked = F.when(F.col("_compiled.error").isNotNull(), refused).otherwise(F.col("_compiled"))
    sets = compiled.select(F.sha2("_text", 256).alias("_digest"), checked.alias(into))
    return requests.withColumn("_digest", F.sha2(F.col(question), 256)).join(sets, "_digest", "left").drop("_digest")
