"""The judging functions as ordinary columns.

``payload`` comes from :mod:`rowjudge.functions.payload`. A question may be a string or a
column (one question per row); NULL payload, question, kind or options give NULL. These
work with any judge that can answer in native expressions, and therefore in ``select``,
``where`` and ``groupBy`` alike. Judges that call out go through
:func:`rowjudge.plans.run.judge_rows`, whose answers the same-named fields are picked from.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowjudge.config import JudgeConfig
from rowjudge.functions.answers import answer_object
from rowjudge.functions.payload import text_payload
from rowjudge.judges.rule import RuleJudge
from rowjudge.operators.question_sets import compile_question_column
from rowjudge.questions import (CHOICE, KINDS, NOUL, PROMPT_INTENT, SCORE, Question, QuestionError, QuestionSet,
                                make_question, parse_questions, resolve_kind)

RULES = RuleJudge()
Options = Sequence[str] | Mapping[str, str | None] | str | Column | None


def _array(options: Sequence[str]) -> Column:
    return F.array(*[F.lit(o) for o in options])


def option_labels(options: Column) -> Column:
    """The labels of an options column of any type that JSON has a list or an object for: ARRAY, MAP of labels to descriptions,
    STRUCT or VARIANT. Descriptions may be NULL."""
    told = F.to_json(options, {"ignoreNullFields": "false"})
    described = F.map_keys(F.from_json(told, "map<string,string>"))
    return F.when(F.startswith(told, F.lit("[")), F.from_json(told, "array<string>")).otherwise(described)


def question_text(kind: str, question: str | Column, options: Column | None = None, *, name: str = "q") -> Column:
    """The text of a one-question set made from columns, for runs whose questions come with the rows. Descriptions go along, so sets
    that differ in them are different sets."""
    text = question if isinstance(question, Column) else F.lit(question)
    start = F.concat(F.lit(f'{{"{name}":{{"type":"{resolve_kind(kind)}","question":'), text_payload(text, max_value_chars=0))
    if options is None:
        return F.concat(start, F.lit("}}"))
    place = "levels" if resolve_kind(kind) == SCORE else "options"
    return F.concat(start, F.lit(f',"{place}":'), F.to_json(options, {"ignoreNullFields": "false"}), F.lit("}}"))


def _column_options(options: Column, kind: str) -> Column:
    options = option_labels(options)
    ok = F.when(F.exists(options, lambda o: o.isNull()),
                F.raise_error(f"a '{kind}' question has a NULL among its options").cast("array<string>"))
    ok = ok.when(F.size(options) == 0,
                 F.raise_error(f"a '{kind}' question needs at least one option").cast("array<string>"))
    return ok.otherwise(options)


def _answer(payload: Column, query: str | Column | None, kind: str, options: Options, judge: RuleJudge,
            needle: str | None = None) -> tuple[Column, Column]:
    """The typed answer, and the condition on question and options under which there is one.
    The payload's own NULL runs through the answer's number or label by itself."""
    asked = F.lit(True)
    if isinstance(query, Column):
        asked = asked & query.isNotNull()
    if kind != NOUL and isinstance(options, Column):
        asked = asked & options.isNotNull()
        return judge.answer(payload, kind, query, _column_options(options, kind)), asked
    if isinstance(query, Column):
        labels = None if kind == NOUL else _array(make_question("?", kind, options).options)
        return judge.answer(payload, kind, query, labels), asked
    question = make_question(query, kind, options, needle=needle)
    labels = _array(question.options) if question.options else None
    return judge.answer(payload, kind, query, labels, question), asked


def _field(payload, query, kind, options, field, type_, judge, needle=None) -> Column:
    if query is None or (kind != NOUL and options is None):
        return F.lit(None).cast(type_)
    answer, asked = _answer(payload, query, kind, options, judge, needle)
    if field == "confidence":
        asked = asked & payload.isNotNull()
    return F.when(asked, answer[field]).cast(type_)


def probability(payload: Column, condition: str | Column | None, *, judge: RuleJudge = RULES,
                needle: str | None = None) -> Column:
    """Probability that the condition holds of the row."""
    return _field(payload, condition, NOUL, None, "noul", "double", judge, needle)


def holds(payload: Column, condition: str | Column | None, threshold: float | Column | None = None, *,
          cfg: JudgeConfig | None = None, judge: RuleJudge = RULES, needle: str | None = None) -> Column:
    """Probability at or above the threshold; a NULL threshold means the configured one."""
    bar = F.lit((cfg or JudgeConfig.active()).threshold)
    if threshold is not None:
        given = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
        bar = F.coalesce(given, bar)
    return probability(payload, condition, judge=judge, needle=needle) >= bar


def score(payload: Column, question: str | Column | None, levels: Options, *, judge: RuleJudge = RULES) -> Column:
    """Position on ordered levels, 0 to n-1."""
    return _field(payload, question, SCORE, levels, "score", "double", judge)


def score_norm(payload: Column, question: str | Column | None, levels: Options, *,
               judge: RuleJudge = RULES) -> Column:
    """The same on 0 to 1."""
    if isinstance(levels, Column):
        top = F.greatest(F.size(option_labels(levels)) - 1, F.lit(1))
    else:
        top = F.lit(max(len(make_question("?", SCORE, levels).options) - 1, 1) if levels is not None else 1)
    return score(payload, question, levels, judge=judge) / top


def choice(payload: Column, question: str | Column | None, options: Options, *, judge: RuleJudge = RULES) -> Column:
    """The winning label, verbatim."""
    return _field(payload, question, CHOICE, options, "choice", "string", judge)


def _by_kind(kind: Column, answer: Callable[[str], Column], type_: str) -> Column:
    lowered = F.lower(kind)
    unknown = F.raise_error(F.concat(F.lit("unknown question kind "), kind)).cast(type_)
    result = F.when(kind.isNull(), F.lit(None).cast(type_))
    for known in KINDS:
        result = result.when(lowered == known, answer(known))
    return result.otherwise(unknown)


def confidence(payload: Column, question: str | Column | None, kind: str | Column | None, options: Options, *,
               judge: RuleJudge = RULES) -> Column:
    """Confidence of the score or choice answer; a yes/no answer has none."""
    if isinstance(kind, Column):
        return _by_kind(kind, lambda k: confidence(payload, question, k, options, judge=judge), "double")
    if kind is None or resolve_kind(kind) == NOUL:
        return F.lit(None).cast("double")
    return _field(payload, question, resolve_kind(kind), options, "confidence", "double", judge)


def evaluate(payload: Column, question: str | Column | None, kind: str | Column | None = NOUL, options: Options = None, *,
             judge: RuleJudge = RULES, needle: str | None = None) -> Column:
    """The full answer as JSON text. The kind may come from a column."""
    if isinstance(kind, Column):
        return _by_kind(kind, lambda k: evaluate(payload, question, k, options, judge=judge, needle=needle), "string")
    if question is None or kind is None:
        return F.lit(None).cast("string")
    kind = resolve_kind(kind)
    if kind != NOUL and options is None:
        raise QuestionError(f"a '{kind}' question needs its options")
    answer, asked = _answer(payload, question, kind, options, judge, needle)
    return F.when(asked & payload.isNotNull(), F.to_json(answer))


def _set_answer(payload: Column, question: Question, judge: RuleJudge) -> Column:
    labels = _array(question.options) if question.options else None
    return judge.answer(payload, question.kind, question.query, labels, question)


def ask(payload: Column, questions: str | dict | QuestionSet | None, *, judge: RuleJudge = RULES) -> Column:
    """All questions of a set at once: a struct with one typed answer per question, in
    question order."""
    if questions is None:
        return F.lit(None).cast("struct<q:string>")
    chosen = questions if isinstance(questions, QuestionSet) else parse_questions(questions)
    fields = [_set_answer(payload, q, judge).alias(q.name) for q in chosen.questions]
    return F.when(payload.isNotNull(), F.struct(*fields))


def ask_json(payload: Column, questions: str | dict | QuestionSet | None, *, judge: RuleJudge = RULES) -> Column:
    """The same as JSON text."""
    if questions is None:
        return F.lit(None).cast("string")
    return F.to_json(ask(payload, questions, judge=judge))


def with_asked(df: DataFrame, payload: Column, questions: Column, *, into: str = "answers",
               cfg: JudgeConfig | None = None, judge: RuleJudge = RULES) -> DataFrame:
    """:func:`ask_json` with a question-set text per row: validated in Arrow batches, once per
    distinct text of a batch, and answered in native expressions."""
    ready = df.withColumn("_payload", payload).withColumn("_asked", questions)
    compiled = compile_question_column(ready, "_asked", (cfg or JudgeConfig.active()).model, into="_qset")
    asked = F.col("_qset.questions")
    answers = F.transform(asked, lambda q: judge.answer_json(F.col("_payload"), q))
    whole = answer_object(F.transform(asked, lambda q: q["name"]), answers)
    return compiled.withColumn(into, F.when(F.col("_payload").isNotNull(), whole)).drop("_payload", "_asked", "_qset")


def intent_of_payload(payload: Column, *, judge: RuleJudge = RULES) -> Column:
    intent, malicious = (_set_answer(payload, q, judge) for q in PROMPT_INTENT.questions)
    return F.when(
        payload.isNotNull(),
        F.struct(
            intent["choice"].alias("intent"),
            intent["confidence"].alias("intent_confidence"),
            intent["probabilities"].alias("intent_probabilities"),
            malicious["noul"].alias("malicious_probability"),
        ),
    )


def _prompt_payload(df: DataFrame, prompt: str, cfg: JudgeConfig | None) -> Column:
    kind = df.schema[prompt].dataType
    if not isinstance(kind, (T.StringType, T.VarcharType, T.CharType, T.NullType)):
        raise TypeError(f"prompt_intent takes a text column, not {kind.simpleString()}")
    return text_payload(F.col(f"`{prompt}`").cast("string"), max_value_chars=cfg.max_value_chars if cfg else None)


def prompt_intent(df: DataFrame, prompt: str, *, cfg: JudgeConfig | None = None,
                  judge: RuleJudge = RULES) -> Column:
    """Intent and malicious probability of a text column. The questions are fixed, and only
    text is accepted, so no other column of the row can be sent along."""
    return intent_of_payload(_prompt_payload(df, prompt, cfg), judge=judge)


def with_prompt_intent(df: DataFrame, prompt: str, *, into: str = "r", cfg: JudgeConfig | None = None,
                       judge: RuleJudge = RULES) -> DataFrame:
    """:func:`prompt_intent` as a column of ``df``. The payload gets a projection of its own, so
    that both questions read it without writing it twice."""
    ready = df.withColumn("_payload", _prompt_payload(df, prompt, cfg))
    return ready.withColumn(into, intent_of_payload(F.col("_payload"), judge=judge)).drop("_payload")
