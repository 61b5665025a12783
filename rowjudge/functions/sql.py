"""The judging functions as temporary SQL functions, answered by the rules.

They are plain SQL expressions that Spark inlines into the query that calls them. A row is
passed as its payload: ``to_json(struct(t.*), map('ignoreNullFields', 'false'))`` for a table
alias, ``text_payload(column)`` for one text column.

By default only ``prompt_intent``, whose questions are fixed, and ``text_payload`` exist. The
functions that take any question come with ``generic=True``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rowjudge.config import JudgeConfig
from rowjudge.judges.rule import P_HIT, P_MISS, last_word
from rowjudge.operators.question_sets import question_compiler
from rowjudge.questions import CHOICE, NOUL, PROMPT_INTENT, SCORE, Question, QuestionSet, parse_questions


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values: tuple[str, ...]) -> str:
    return f"array({', '.join(map(_text, values))})"


def _noul(payload: str, word: str) -> str:
    hit = f"{word} <> '' AND contains(lower({payload}), {word})"
    return f"element_at(array({P_MISS}D, {P_HIT}D), CAST(({hit}) AS INT) + 1)"


def _at(payload: str, options: str) -> str:
    return f"CAST(pmod(length({payload}), size({options})) AS INT)"


def _one_hot(keys: str, at: str) -> str:
    return f"map_from_arrays({keys}, array_insert(array_repeat(0.0D, size({keys}) - 1), {at} + 1, 1.0D))"


def _answer(payload: str, kind: str, word: str, options: str) -> str:
    """The typed answer of one question."""
    at = _at(payload, options)
    if kind == NOUL:
        return f"named_struct('type', '{NOUL}', 'noul', {_noul(payload, word)})"
    if kind == SCORE:
        levels = f"transform({options}, (o, i) -> CAST(i AS STRING))"
        return (f"named_struct('type', '{SCORE}', 'score', CAST({at} AS DOUBLE), "
                f"'legend', map_from_arrays({levels}, {options}), 'probabilities', {_one_hot(levels, at)}, "
                f"'confidence', 1.0D)")
    return (f"named_struct('type', '{CHOICE}', 'choice', element_at({options}, {at} + 1), "
            f"'probabilities', {_one_hot(options, at)}, 'confidence', 1.0D)")


def _asked(question: Question) -> str:
    options = tuple(dict.fromkeys(question.options))
    word = question.needle or last_word(question.query)
    return _answer("payload", question.kind, _text(word.lower()), _texts(options))


_WORD = r"lower(element_at(split(trim(question), '\\s+'), -1))"
_OPTIONS = """(CASE WHEN size(options) = 0 THEN raise_error('a question needs at least one option')
    WHEN exists(options, o -> o IS NULL) THEN raise_error('a question has a NULL among its options')
    ELSE array_distinct(options) END)"""


def _generic(cfg: JudgeConfig) -> dict[str, str]:
    """Signature to body. NULL in gives NULL out, except that a NULL threshold is the setting."""
    at = _at("payload", _OPTIONS)
    known = "payload IS NOT NULL AND question IS NOT NULL AND options IS NOT NULL"
    score = f"CASE WHEN question IS NOT NULL THEN CAST({at} AS DOUBLE) END"
    noul = f"CASE WHEN question IS NOT NULL THEN {_noul('payload', _WORD)} END"
    kinds = {kind: f"to_json({_answer('payload', kind, _WORD, _OPTIONS)})" for kind in (NOUL, SCORE, CHOICE)}
    unknown = "raise_error(concat('unknown question kind ', kind))"
    missing = "raise_error(concat('a question needs its options: ', kind))"
    return {
        "judge(payload STRING, question STRING, threshold DOUBLE DEFAULT NULL) RETURNS BOOLEAN":
            f"{noul} >= coalesce(threshold, {cfg.threshold}D)",
        "judge_prob(payload STRING, question STRING) RETURNS DOUBLE": noul,
        "judge_score(payload STRING, question STRING, options ARRAY<STRING>) RETURNS DOUBLE": score,
        "judge_score_norm(payload STRING, question STRING, options ARRAY<STRING>) RETURNS DOUBLE":
            f"({score}) / greatest(size(options) - 1, 1)",
        "judge_choice(payload STRING, question STRING, options ARRAY<STRING>) RETURNS STRING":
            f"CASE WHEN question IS NOT NULL THEN element_at({_OPTIONS}, {at} + 1) END",
        "judge_confidence(payload STRING, question STRING, kind STRING, options ARRAY<STRING>) RETURNS DOUBLE":
            f"""CASE WHEN {known} AND kind IS NOT NULL AND lower(kind) <> '{NOUL}' THEN
                CASE lower(kind) WHEN '{SCORE}' THEN array_max(map_values({_answer('payload', SCORE, _WORD, _OPTIONS)}.probabilities))
                  WHEN '{CHOICE}' THEN array_max(map_values({_answer('payload', CHOICE, _WORD, _OPTIONS)}.probabilities)) ELSE {unknown} END END""",
        "judge_eval(payload STRING, question STRING, kind STRING DEFAULT 'noul', options ARRAY<STRING> DEFAULT array()) "
        "RETURNS STRING":
            f"""CASE WHEN payload IS NULL OR question IS NULL OR kind IS NULL THEN NULL
                WHEN lower(kind) = '{NOUL}' THEN {kinds[NOUL]}
                WHEN lower(kind) NOT IN ('{SCORE}', '{CHOICE}') THEN {unknown}
                WHEN options IS NULL THEN NULL WHEN size(options) = 0 THEN {missing}
                WHEN lower(kind) = '{SCORE}' THEN {kinds[SCORE]} ELSE {kinds[CHOICE]} END""",
    }


def _described(generic: dict[str, str]) -> dict[str, str]:
    """The functions with options once more for MAPs of labels to descriptions, which may be NULL. The rules answer by labels."""
    described = {}
    for signature, body in generic.items():
        if "options ARRAY<STRING>" in signature:
            name, rest = signature.split("(", 1)
            given, returns = rest.split(") RETURNS")
            passed = ", ".join("map_keys(options)" if a.startswith("options ") else a.split()[0] for a in given.split(", "))
            arguments = given.replace("options ARRAY<STRING>", "options MAP<STRING, STRING>").replace(
                "DEFAULT array()", "DEFAULT CAST(map() AS MAP<STRING, STRING>)")
            described[f"{name}_described({arguments}) RETURNS{returns}"] = f"{name}({passed})"
    return described


def _ask() -> str:
    """All questions of the set that comes with the row, compiled once per distinct text of an Arrow batch; what is refused stops the
    query."""
    word = r"lower(coalesce(q.needle, element_at(split(trim(q.query), '\\s+'), -1)))"
    of = {kind: f"to_json({_answer('payload', kind, word, 'array_distinct(q.options)')})" for kind in (NOUL, SCORE, CHOICE)}
    answer = f"CASE q.kind WHEN '{NOUL}' THEN {of[NOUL]} WHEN '{SCORE}' THEN {of[SCORE]} ELSE {of[CHOICE]} END"
    named = f"concat('\"', q.name, '\":', {answer})"
    whole = f"concat('{{', array_join(transform(s.questions, q -> {named}), ','), '}}')"
    return f"""CASE WHEN payload IS NOT NULL AND questions IS NOT NULL THEN element_at(transform(array(judge_compile(questions)),
        s -> CASE WHEN s.error IS NOT NULL THEN raise_error(s.error) ELSE {whole} END), 1) END"""


def _create(spark: SparkSession, signature: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")


def register_ask(spark: SparkSession, name: str, questions: str | dict | QuestionSet) -> None:
    """``name(payload)`` gives the JSON answers of one question set, in question order."""
    chosen = questions if isinstance(questions, QuestionSet) else parse_questions(questions)
    fields = ", ".join(f"'{q.name}', {_asked(q)}" for q in chosen.questions)
    _create(spark, f"{name}(payload STRING) RETURNS STRING",
            f"CASE WHEN payload IS NOT NULL THEN to_json(named_struct({fields})) END")


def register(spark: SparkSession, *, generic: bool = False, cfg: JudgeConfig | None = None) -> None:
    cfg = cfg or JudgeConfig.from_conf(spark)
    cut = f"substring(value, 1, {cfg.max_value_chars})" if cfg.max_value_chars else "value"
    bare = f"""rtrim('}}', substring(to_json(named_struct('v', {cut}), map('ignoreNullFields', 'false')), 6))"""
    text_payload = f"CASE WHEN value IS NOT NULL THEN {bare} END"
    _create(spark, "text_payload(value STRING) RETURNS STRING", text_payload)
    intent, malicious = (_asked(q).replace("payload", "p.payload") for q in PROMPT_INTENT.questions)
    _create(
        spark,
        "prompt_intent(value STRING) RETURNS STRUCT<intent: STRING, intent_confidence: DOUBLE, "
        "intent_probabilities: MAP<STRING, DOUBLE>, malicious_probability: DOUBLE>",
        f"""CASE WHEN value IS NOT NULL THEN element_at(transform(array(named_struct('payload', {bare})),
            p -> named_struct('intent', {intent}.choice, 'intent_confidence', {intent}.confidence,
              'intent_probabilities', {intent}.probabilities, 'malicious_probability', {malicious}.noul)), 1) END""",
    )
    if generic:
        functions = _generic(cfg)
        for signature, body in (functions | _described(functions)).items():
            _create(spark, signature, body)
        spark.udf.register("judge_compile", question_compiler(cfg.model))
        _create(spark, "judge_ask(payload STRING, questions STRING) RETURNS STRING", _ask())
