"""A judge in process for the tests. It reads a request as its receiver would, finds what each item is asked, and answers by
what the tests can tell beforehand. Words in the questions or items make it fail in the ways a remote judge can."""

from __future__ import annotations

import json

from rowjudge.judges.callable import JudgeError

#: A word in a question, and what the judge does about it.
MOODS = {"forbidden": JudgeError("refused", 422), "swamped": JudgeError("overloaded", 503),
         "unplugged": ConnectionError("connection dropped"), "crashing": ValueError("a bug")}
POISON = "poisoned"  # in an item: the whole request is refused


def verdict(kind: str, entry: dict, item) -> dict:
    """Yes/no: does the item hold a word of the question that is as long as its longest. Choice and score: the option that the
    item's letters, added up, fall on."""
    written = json.dumps(item, ensure_ascii=False, separators=(",", ":"))
    if kind != "noul":
        names = list(entry.get("levels") or entry["labels"])
        winner = names[sum(map(ord, written)) % len(names)]
        shares = {name: 1.0 if name == winner else 0.0 for name in names}
        if kind == "score":
            return {"type": "score", "score": float(names.index(winner)), "confidence": max(shares.values()),
                    "legend": dict(zip(map(str, range(len(names))), names)),
                    "probabilities": dict(zip(map(str, range(len(names))), shares.values()))}
        return {"type": "choice", "choice": winner, "confidence": max(shares.values()), "probabilities": shares,
                "explained": sorted(name for name, text in entry["labels"].items() if text)}
    words = entry["question"].lower().split()
    longest = {word for word in words if len(word) == max(map(len, words))}
    return {"type": "noul", "noul": 0.9 if any(word in written.lower() for word in longest) else 0.1}


def strict(request: str, timeout: float) -> str:
    body = json.loads(request)
    state, asked = body["state"], dict(body["questions"])
    words = {w for entry in state["rubric"].values() for w in entry["question"].split()}
    for word in words & MOODS.keys():
        raise MOODS[word]
    if POISON in json.dumps(state["items"]):
        raise JudgeError("refused", 422)
    if "speechless" in words:
        return json.dumps({"model": body["model"]})
    answers = {}
    for place, (number, item) in enumerate(state["items"].items(), 1):
        if number != str(place):
            raise JudgeError("the items aren't numbered from 1", 422)
        for name, entry in state["rubric"].items():
            question = asked.pop(f"item_{number}_{name}", None)
            told = (question or {}).get("instructions", "")
            if f"rubric.{name}" not in told or f'items."{number}"' not in told:
                raise JudgeError(f"item {number} isn't asked {name}", 422)
            answers[f"item_{number}_{name}"] = None if "unsure" in words else verdict(question["type"], entry, item)
    if asked:
        raise JudgeError("there are questions about no item", 422)
    if "halfway" in words:
        answers.pop(max(answers))
    return json.dumps({"model": body["model"], "answers": answers,
                       "usage": {"input_tokens": len(request) // 4, "output_tokens": len(answers)}})
