"""Rows as JSON payloads: what a judge reads, and what answers are keyed by.

The payload is built from the *schema*, on the driver, as one native expression, so a
query that judges two columns reads two columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowjudge.config import JudgeConfig

_KEEP_NULLS = {"ignoreNullFields": "false"}

_AS_TEXT = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType,
            T.CalendarIntervalType, *([T.TimeType] if hasattr(T, "TimeType") else []))


def _limit(max_value_chars: int | None) -> int:
    return JudgeConfig.active().max_value_chars if max_value_chars is None else max_value_chars


def _needs_work(kind: T.DataType, limit: int) -> bool:
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return limit > 0
    if isinstance(kind, T.ArrayType):
        return _needs_work(kind.elementType, limit)
    if isinstance(kind, T.MapType):
        return _needs_work(kind.valueType, limit) or isinstance(kind.keyType, _AS_TEXT)
    if isinstance(kind, T.StructType):
        return any(_needs_work(f.dataType, limit) for f in kind.fields)
    return isinstance(kind, (T.FractionalType, *_AS_TEXT)) and not isinstance(kind, T.DecimalType)


def prepared(value: Column, kind: T.DataType, limit: int) -> Column:
    """``value`` as it is written to the payload: strings cut to ``limit`` code points at
    every depth, non-finite numbers NULL, dates and times in their text form."""
    if not _needs_work(kind, limit):
        return value
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.substring(value, 1, limit)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        infinity = F.lit(float("inf"))
        return F.when(~F.isnan(value) & (F.abs(value) != infinity), value)
    if isinstance(kind, _AS_TEXT):
        return value.cast("string")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: prepared(x, kind.elementType, limit))
    if isinstance(kind, T.MapType):
        if isinstance(kind.keyType, _AS_TEXT):
            value = F.transform_keys(value, lambda k, v: k.cast("string"))
        return F.transform_values(value, lambda k, v: prepared(v, kind.valueType, limit))
    fields = [prepared(value.getField(f.name), f.dataType, limit).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def row_payload(df: DataFrame, columns: Sequence[str] | None = None, *, max_value_chars: int | None = None) -> Column:
    """A whole row, or the named columns of it, as a JSON object with the column names. Texts stay whole unless
    ``max_value_chars``, here or in the session's settings, says where to cut them (0: nowhere)."""
    max_value_chars = _limit(max_value_chars)
    fields = [df.schema[c] for c in (columns or df.columns)]
    cells = [prepared(F.col(f"`{f.name}`"), f.dataType, max_value_chars).alias(f.name) for f in fields]
    return F.to_json(F.struct(*cells), _KEEP_NULLS)


def _bare(value: Column) -> Column:
    # to_json takes no scalars: write {"v":<value>} and keep what is between the braces. No
    # bare value ends in a brace, so trimming is safe, and it reads the text only once.
    wrapped = F.to_json(F.struct(value.alias("v")), _KEEP_NULLS)
    return F.rtrim(F.substring(wrapped, 6, 2**31 - 1), F.lit("}"))


def value_payload(df: DataFrame, column: str, *, max_value_chars: int | None = None) -> Column:
    """One column as a bare JSON value; NULL stays NULL (it is never sent)."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    ready = prepared(value, kind, _limit(max_value_chars))
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(ready, _KEEP_NULLS)
    if isinstance(kind, T.VariantType):  # may be an object, so its own braces must stay
        wrapped = F.to_json(F.struct(ready.alias("v")), _KEEP_NULLS)
        return F.when(value.isNotNull(), F.substr(wrapped, F.lit(6), F.length(wrapped) - 6))
    return F.when(value.isNotNull(), _bare(ready))


def text_payload(text: Column | str, *, max_value_chars: int | None = None) -> Column:
    """A text column as a bare JSON string, where no DataFrame is at hand."""
    text = F.col(text) if isinstance(text, str) else text
    limit = _limit(max_value_chars)
    cut = F.substring(text, 1, limit) if limit else text
    return F.when(text.isNotNull(), _bare(cut))


def payload_bytes(payload: Column | str) -> Column:
    """The measure of the size cap: UTF-8 bytes of the payload."""
    return F.octet_length(payload).cast("bigint")


def estimate_tokens(text: Column | str) -> Column:
    """ceil(ASCII bytes / 3) + two-byte characters + 2 x wider characters. Pure ASCII text,
    which byte and character counts give away, needs no pattern matching."""
    text = F.col(text) if isinstance(text, str) else text
    bytes_, chars = F.octet_length(text), F.length(text)
    ascii_ = F.length(F.regexp_replace(text, r"[^\x00-\x7F]+", ""))
    # bytes = ascii + 2 two + 3 three + 4 four, and the UTF-16 length counts four-byte
    # characters twice, so one pattern is enough to tell the four classes apart.
    four = F.octet_length(F.encode(text, "UTF-16BE")) / 2 - chars
    wide = bytes_ - 2 * chars + ascii_ - four
    mixed = F.floor((ascii_ + 2) / 3) + (chars - ascii_ - wide) + 2 * wide
    return F.when(bytes_ == chars, F.floor((bytes_ + 2) / 3)).otherwise(mixed).cast("bigint")
