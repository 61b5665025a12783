"""Fields of raw JSON answers. A field that is missing or of the wrong JSON type is NULL,
never a default; an answer that is no JSON at all is an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_parsed(answer: Column, use: Callable[[Column], Column]) -> Column:
    complaint = F.raise_error(F.concat(F.lit("an answer is no JSON: "), answer)).cast("variant")
    return _once(F.try_parse_json(answer),
                 lambda v: use(F.when(answer.isNotNull() & v.isNull(), complaint).otherwise(v)))


def _is_number(value: Column) -> Column:
    return F.schema_of_variant(value).rlike(_NUMBER)


def _number(parsed: Column, name: str) -> Column:
    return _once(F.variant_get(parsed, f"$.{name}", "variant"), lambda v: F.when(_is_number(v), v.cast("double")))


def _text(parsed: Column, name: str) -> Column:
    return _once(F.variant_get(parsed, f"$.{name}", "variant"),
                 lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string")))


def number_field(answer: Column, name: str) -> Column:
    return _with_parsed(answer, lambda parsed: _number(parsed, name))


def text_field(answer: Column, name: str) -> Column:
    return _with_parsed(answer, lambda parsed: _text(parsed, name))


def probabilities(answer: Column) -> Column:
    """Label to probability, in the answer's own order; entries that are no numbers are left
    out, and anything but an object gives NULL."""
    entries = F.from_json(answer, "probabilities map<string,variant>")["probabilities"]
    numbers = F.map_filter(entries, lambda _, v: F.coalesce(_is_number(v), F.lit(False)))
    return F.transform_values(numbers, lambda _, v: v.cast("double"))


def prompt_intent_of(intent: Column, malicious: Column) -> Column:
    """The four-field struct of the built-in prompt questions."""
    def fields(parsed: Column) -> Column:
        return F.struct(
            _text(parsed, "choice").alias("intent"),
            _number(parsed, "confidence").alias("intent_confidence"),
            probabilities(intent).alias("intent_probabilities"),
            number_field(malicious, "noul").alias("malicious_probability"),
        )

    return F.when(intent.isNotNull() & malicious.isNotNull(), _with_parsed(intent, fields))


def answer_object(names: Column, answers: Column) -> Column:
    """``{"<name>": <answer>, ...}`` in question order, the answers verbatim."""
    pairs = F.zip_with(names, answers, lambda n, a: F.concat(F.lit('"'), n, F.lit('":'), a))
    return F.when(answers.isNotNull(), F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")))
