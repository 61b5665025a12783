from __future__ import annotations

import hashlib
import random
import re

from rowjudge.llm import pii


def plain(text: str) -> list[tuple[int, int, int]]:
    """The base patterns as they are stated, by the regex engine alone."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        odd = [sum(divmod(2 * x, 10)) for x in d[-2::-2]]
        if 14 <= len(d) <= 19 and (sum(d[::-2]) + sum(odd)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_equal_the_stated_patterns():
    rng = random.Random(3)
    pieces = ["@", "a", "b.c", ".", "-", " ", "+1", "12", "255", "300.", "1.2.3.4", "4111 1111 1111 1111", "(555)", "é", "x@y.z", "%", "\n", "0"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_are_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000):
        pii.base_spans(text)


def test_odd_rows(odd_docs, no_docs):
    rows = pii.find_pii(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[10]["n_email"] == 1 and found[10]["n_phone"] == 1
    assert [s["kind"] for s in found[10]["spans"]] == ["email", "phone"]
    assert found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find_pii(no_docs).count() == 0


def test_reliable_labelers_win():
    """A labeler that contradicts the other three loses its say."""
    code = lambda votes: sum((v + 1) * 3 ** (3 - i) for i, v in enumerate(votes))
    sure = pii.reliabilities({(6, code((1, 1, 1, 0))): 200, (6, code((1, -1, -1, 0))): 200, (6, code((1, 1, 1, -1))): 20})
    assert sure[6, code((1, 1, 1, 0))] > 0.9 > 0.1 > sure[6, code((1, -1, -1, 0))]


def test_persons_and_masked_addresses_are_added_where_context_speaks_for_them(spark):
    texts = [f"please contact Dr. {a} {b} soon" for a in ("Maria", "Peter", "Anna") for b in ("Kohl", "Stone", "Reed")] * 4
    texts += [f"my email is bob{i} (at) example (dot) com thanks" for i in range(20)] + ["order page 555-123-4567 part"] * 10 + ["plain words"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find_pii(docs).collect()}
    assert all(spans[i] == ["person"] for i in range(36)) and all(spans[i] == ["email_masked"] for i in range(36, 56))
    assert not any(spans[i] for i in range(56, 86))


def test_redaction_leaves_clean_texts(odd_docs):
    rows = {r["doc_id"]: r["text"] for r in pii.redact(odd_docs).where("doc_id IS NOT NULL").collect()}
    assert rows[10] == "mail [EMAIL] or [PHONE] now" and rows[8] == "one two three" and rows[1] is None


def added(text: str) -> list[tuple[str, str]]:
    return [(pii.KINDS[k], text[s:e]) for s, k, e in pii.more_spans(text, [])]


def test_masked_addresses_in_capitals():
    assert added("WRITE TO JOHN [AT] EXAMPLE [DOT] COM") == [("email_masked", "JOHN [AT] EXAMPLE [DOT] COM")]


def test_names_are_taken_whole():
    for name in ("Müller", "McDonald", "O'Brien", "Élodie Lefèvre-Duval", "Ana Núñez", "Ångström"):
        assert added(f"see Dr. {name}, please") == [("person", name)]


def test_titles_and_cues_of_four_languages():
    for before in ("Mr.", "Herr", "Herrn", "Frau", "M.", "Mme", "Monsieur", "Sr.", "Sra.", "Señor", "Doña", "My name is",
                   "mein Name ist", "Ich heiße", "Ansprechpartner:", "je m'appelle", "signé par", "me llamo", "Mi nombre es"):
        assert added(f"so {before} Karl Weiß.") == [("person", "Karl Weiß")], before
    assert added("ein Herr geht, die Frau singt, don Quijote m. Weiß") == []


def test_secrets_are_added_and_words_are_not(spark):
    rng = random.Random(4)
    secret = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    words = "alpha beta gamma delta omega sigma".split()
    texts = [f"{rng.choice(words)} {rng.choice(words)} {name} = \"{secret(n)}\" {rng.choice(words)}"
             for name in ("token", "api key", "secret") for n in (40, 64) for _ in range(6)]
    texts += [f"see docs/2024/05/{rng.choice(words)}-{rng.choice(words)}-part-2-of-17/index of {w}" for w in words * 3]
    texts += ["Donaudampfschifffahrtsgesellschaft 1234567890123456789012345", "1" * 50, "é" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "secret"] for r in pii.find_pii(docs).collect()}
    assert all(len(spans[i]) == 1 and len(spans[i][0]) in (40, 64) for i in range(36))
    assert not any(spans[i] for i in range(36, len(texts)))


def test_the_votes_decide(spark, monkeypatch):
    """With reliabilities that are turned round, what was added is not, and the base spans stay."""
    texts = [f"please contact Dr. {a} {b} or {a}{i}@example.com" for i, (a, b) in enumerate([("Maria", "Kohl"), ("Peter", "Stone")] * 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    learned = pii.reliabilities
    assert {s["kind"] for r in pii.find_pii(docs).collect() for s in r["spans"]} == {"person", "email"}
    monkeypatch.setattr(pii, "reliabilities", lambda counts, cfg: {k: 1 - v for k, v in learned(counts, cfg).items()})
    assert {s["kind"] for r in pii.find_pii(docs).collect() for s in r["spans"]} == {"email"}
