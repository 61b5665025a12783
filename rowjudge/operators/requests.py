"""The request of one batch: the rubric once, the items by number, and one pointer question
per (item, question)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowjudge.functions.payload import text_payload
from rowjudge.questions import ITEM_SLOT, QuestionSet, compact_json


def request_body(model: str, chosen: QuestionSet, payloads: Sequence[str]) -> str:
    """The body as Python text, for constants and tests. Payloads go in verbatim: parsing and
    rewriting them would turn 1.50 into 1.5."""
    numbered = list(enumerate(payloads, 1))
    items = ",".join(f'"{n}":{payload}' for n, payload in numbered)
    asked = ",".join(t.replace(ITEM_SLOT, str(n)) for n, _ in numbered for t in chosen.item_templates)
    return (f'{{"model":{compact_json(model)},"state":{{"rubric":{chosen.rubric_json},"items":{{{items}}}}},'
            f'"questions":{{{asked}}}}}')


def text_tokens(text: str) -> int:
    """:func:`rowjudge.functions.payload.estimate_tokens` for a driver-side constant."""
    narrow = sum(c < "\x80" for c in text)
    two = sum("\x80" <= c < "ࠀ" for c in text)
    return (narrow + 2) // 3 + two + 2 * (len(text) - narrow - two)


def request_size(model: str, chosen: QuestionSet) -> tuple[int, int]:
    """Estimated tokens of a request without items, and what each item adds to its payload."""
    empty = text_tokens(request_body(model, chosen, []))
    one = text_tokens(request_body(model, chosen, ["0"]))
    return empty, max(one - empty, 0)


def request_column(model: Column, qset: Column, payloads: Column) -> Column:
    """The same body as a native expression over a batch row."""
    items = F.transform(payloads, lambda p, i: F.concat(F.lit('"'), (i + 1).cast("string"), F.lit('":'), p))
    asked = F.transform(
        payloads,
        lambda _, i: F.array_join(
            F.transform(qset["templates"], lambda t: F.replace(t, F.lit(ITEM_SLOT), (i + 1).cast("string"))), ","),
    )
    return F.concat(
        F.lit('{"model":'), text_payload(model, max_value_chars=0), F.lit(',"state":{"rubric":'), qset["rubric"], F.lit(',"items":{'),
        F.array_join(items, ","), F.lit('}},"questions":{'), F.array_join(asked, ","), F.lit("}}"),
    )
