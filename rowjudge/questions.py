"""Questions, question sets and their validation (all of it on the driver, except
for question texts that live in a column: see :mod:`rowjudge.operators.question_sets`).
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

# The answer kinds and the limits of a question set.
NOUL, SCORE, CHOICE = "noul", "score", "choice"
KINDS = (NOUL, SCORE, CHOICE)
MAX_QUESTIONS = 16
MAX_OPTIONS = 255
MIN_LEVELS, MAX_LEVELS = 2, 10
NAME_PATTERN = re.compile(r"[A-Za-z0-9_]{1,64}")

# Per-item wording of each kind; {rubric} and {item} are filled in.
POINTERS = {
    NOUL: "Using {rubric} in the state: is it true of {item}?",
    SCORE: "Using {rubric} in the state, rate {item}.",
    CHOICE: "Using {rubric} in the state, classify {item}.",
}

# Stands for the item number in a question template until the batch is known.
ITEM_SLOT = "\ue000"


class QuestionError(ValueError):
    """A question that cannot be asked as written."""


def compact_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


@dataclass(frozen=True)
class Question:
    """One question. ``descriptions`` runs parallel to ``options`` for a choice, and is
    empty or (what true means, what false means) for a yes/no question. ``needle`` only
    steers the rule judge and is no part of the identity."""

    kind: str
    query: str
    options: tuple[str, ...] = ()
    descriptions: tuple[str | None, ...] = ()
    name: str = "q"
    pointer: str = ""
    needle: str | None = None

    def rubric(self) -> dict:
        entry: dict = {"question": self.query}
        if self.kind == SCORE:
            entry["levels"] = list(self.options)
        elif self.kind == CHOICE:
            told = self.descriptions or (None,) * len(self.options)
            entry["labels"] = {o: d or None for o, d in zip(self.options, told)}
        elif self.descriptions:
            entry["labels"] = dict(zip(("true", "false"), self.descriptions))
        return entry

    def item_question(self, item: str) -> dict:
        wording = self.pointer or POINTERS[self.kind]
        asked = {
            "type": self.kind,
            "instructions": wording.format(rubric=f"rubric.{self.name}", item=f'items."{item}"'),
        }
        if self.kind == SCORE:
            asked["criteria"] = list(self.options)
        elif self.kind == CHOICE:
            asked["criteria"] = {option: "see rubric" for option in self.options}
        return asked

    def identity(self) -> dict:
        """Everything that is sent, hence everything that makes an answer reusable."""
        return {
            "name": self.name,
            "pointer": self.pointer,
            "kind": self.kind,
            "query": self.query,
            "options": list(self.options),
            "descriptions": [d or "" for d in self.descriptions],
        }


@dataclass(frozen=True)
class QuestionSet:
    """Questions answered together, in one request."""

    questions: tuple[Question, ...]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(q.name for q in self.questions)

    @property
    def set_key(self) -> str:
        return hashlib.sha256(compact_json([q.identity() for q in self.questions]).encode()).hexdigest()

    @property
    def rubric_json(self) -> str:
        return compact_json({q.name: q.rubric() for q in self.questions})

    @property
    def item_templates(self) -> tuple[str, ...]:
        """``"item_<n>_<name>":{...}`` per question, with ITEM_SLOT for ``<n>``."""
        return tuple(
            f'"item_{ITEM_SLOT}_{q.name}":'
            + compact_json(q.item_question(ITEM_SLOT))
            for q in self.questions
        )


def single(question: Question) -> QuestionSet:
    return QuestionSet((question,))


def resolve_kind(kind: str) -> str:
    lowered = kind.lower()
    if lowered not in KINDS:
        raise QuestionError(f"unknown question kind '{lowered}': use one of {', '.join(KINDS)}")
    return lowered


def _list_literal(text: str) -> list[str]:
    """``'[a, b]'`` is a list of two labels, as in SQL."""
    inner = text.strip()
    if not (inner.startswith("[") and inner.endswith("]")):
        raise QuestionError("a text is no list of labels, unless it reads '[a, b]'")
    return [part.strip().strip("'\"") for part in inner[1:-1].split(",") if part.strip()]


def make_question(query: str, kind: str = NOUL, options=None, *, name: str = "q", criteria=None,
                  pointer: str = "", needle: str | None = None) -> Question:
    """The lenient constructor behind the single-question functions: repeated options, one
    level or more than ten are let through, as only an ``ask`` set is checked strictly."""
    kind = resolve_kind(kind)
    if kind == NOUL:
        return Question(NOUL, query, (), tuple(criteria or ()), name, pointer, needle)
    if options is None:
        raise QuestionError(f"a '{kind}' question needs its options")
    descriptions: tuple = ()
    if isinstance(options, str):
        options = _list_literal(options)
    if isinstance(options, dict):
        if kind != CHOICE:
            raise QuestionError(f"only a 'choice' question takes label descriptions, and this is a '{kind}'")
        descriptions = tuple(options.values())
        options = list(options)
    if any(o is None for o in options):
        raise QuestionError(f"a '{kind}' question has a NULL among its options")
    if not options:
        raise QuestionError(f"a '{kind}' question needs at least one option")
    return Question(kind, query, tuple(str(o) for o in options), descriptions, name, pointer, needle)


def _text_field(spec: dict, field: str, name: str) -> str:
    value = spec.get(field)
    if not isinstance(value, str) or not value:
        raise QuestionError(f"'{name}': \"{field}\" is to be text, and not empty")
    return value


def _labels(spec: dict, name: str) -> tuple[list[str], list[str | None]]:
    if "options" not in spec:
        raise QuestionError(f"choice question '{name}' comes without \"options\"")
    options = spec["options"]
    if isinstance(options, list):
        labels, told = options, []
    elif isinstance(options, dict):
        labels, told = list(options), list(options.values())
        if any(not isinstance(d, (str, type(None))) for d in told):
            raise QuestionError(f"'{name}' describes an option by something other than text or null")
    else:
        raise QuestionError(f"'{name}' wants its options as an array, or as an object that describes them")
    if any(not isinstance(label, str) or not label for label in labels):
        raise QuestionError(f"'{name}' has an option that is empty or no text")
    if not 1 <= len(labels) <= MAX_OPTIONS:
        raise QuestionError(f"choice question '{name}' has {len(labels)} options, not 1 to {MAX_OPTIONS}")
    for i, label in enumerate(labels):
        if label in labels[:i]:
            raise QuestionError(f"'{name}' lists the option '{label}' twice")
    return labels, told


def _levels(spec: dict, name: str) -> list[str]:
    levels = spec.get("levels")
    if not isinstance(levels, list):
        raise QuestionError(f"score question '{name}' comes without a list of \"levels\"")
    if any(not isinstance(level, str) or not level for level in levels):
        raise QuestionError(f"'{name}' has a level that is empty or no text")
    if not MIN_LEVELS <= len(levels) <= MAX_LEVELS:
        raise QuestionError(f"'{name}' is a score, which has from {MIN_LEVELS} to {MAX_LEVELS} levels")
    return levels


def _criteria(spec: dict, name: str) -> list[str]:
    if "criteria" not in spec:
        return []
    criteria = spec["criteria"]
    if (not isinstance(criteria, dict) or set(criteria) != {"true", "false"}
            or not all(isinstance(v, str) for v in criteria.values())):
        raise QuestionError(f"'{name}' gives criteria that aren't an object of two texts, \"true\" and \"false\"")
    return [criteria["true"], criteria["false"]]


# The one field beyond "type" and "question" that each kind accepts.
_OWN_FIELD = {NOUL: "criteria", SCORE: "levels", CHOICE: "options"}


def _named_question(name: str, spec) -> Question:
    if not NAME_PATTERN.fullmatch(name):
        raise QuestionError(f"'{name}' can't be the name of a question: up to 64 of A-Z, a-z, 0-9 and _ can")
    if not isinstance(spec, dict):
        raise QuestionError(f"'{name}' is no object that says what to ask")
    kind = _text_field(spec, "type", name).lower()
    if kind not in KINDS:
        raise QuestionError(f"'{name}' is of type '{kind}', but there are only {', '.join(KINDS)}")
    query = _text_field(spec, "question", name)
    for field in spec:
        if field not in ("type", "question", _OWN_FIELD[kind]):
            raise QuestionError(f"a {kind} question has no field \"{field}\" ('{name}')")
    if kind == CHOICE:
        labels, told = _labels(spec, name)
        return Question(kind, query, tuple(labels), tuple(told), name)
    if kind == SCORE:
        return Question(kind, query, tuple(_levels(spec, name)), (), name)
    return Question(kind, query, (), tuple(_criteria(spec, name)), name)


def parse_questions(questions: str | dict) -> QuestionSet:
    """Validate ``{"name": {"type": ..., "question": ..., ...}, ...}``. Unknown fields are
    errors, so a typo cannot drop a description silently."""
    if isinstance(questions, str):
        try:
            questions = json.loads(questions)
        except ValueError as error:
            raise QuestionError(f"the question set can't be read as JSON: {error}") from None
    if not isinstance(questions, dict) or not questions:
        raise QuestionError("a question set is an object with a question under each name, one at least")
    if len(questions) > MAX_QUESTIONS:
        raise QuestionError(f"{len(questions)} questions are more than the {MAX_QUESTIONS} of one request")
    return QuestionSet(tuple(_named_question(name, spec) for name, spec in questions.items()))


# The built-in prompt taxonomy (labels, descriptions, wording).
PROMPT_INTENT = QuestionSet((
    Question(
        name="intent",
        kind=CHOICE,
        query="What is the primary intent of this user prompt sent to an AI assistant?",
        options=("work_related", "personal", "other"),
        descriptions=(
            "Asks for help with a job task: code, data, documents, analysis, business communication",
            "Personal life, hobbies, health, relationships, shopping, entertainment — not a job task",
            "Too short, empty, or ambiguous to place in either label above",
        ),
    ),
    Question(
        name="malicious",
        kind=NOUL,
        query="Does this user prompt try to misuse, attack, or cause harm through an AI assistant?",
        descriptions=(
            "Tries to cause harm or misuse the assistant: jailbreaks, prompt injection, malware, fraud, "
            "harassment, extracting secrets or credentials",
            "An ordinary request, whatever its topic",
        ),
        pointer="Using {rubric} in the state: is {item} malicious?",
    ),
))
