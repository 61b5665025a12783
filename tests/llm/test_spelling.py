from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowjudge.llm import spelling
from rowjudge.llm.spelling import SpellingConfig, near_pairs


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b))) and len(b) - len(a) == 1


def brute(docs, least: int = 5, times: int = 3) -> dict:
    counts: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= times}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def told(df) -> dict:
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


@given(st.lists(st.text("abé", max_size=6), max_size=25))
@settings(deadline=None, max_examples=300)
def test_scan_finds_each_pair_once(words):
    words = sorted(set(words))
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}
    got = [(i, j) for i, j, _ in near_pairs(words)]
    assert len(got) == len(set(got)) and set(got) == want


SYLLABLES = ["ab", "ba", "an", "na", "éa"]


@pytest.fixture(scope="module")
def made():
    words = [a + b + c for a in SYLLABLES for b in SYLLABLES for c in SYLLABLES]
    words += [w[:i] + w[i + 1:] for w in words for i in (0, 3)] + [w + "n" for w in words[:40]]
    return [(i, " ".join(words[(i * 37 + j * (i % 5 + 1)) % len(words)] for j in range(400)) + ".") for i in range(12)]


@pytest.mark.parametrize("cfg", [SpellingConfig(), SpellingConfig(max_list=2), SpellingConfig(spans=1, max_list=8, flush=10),
                                 SpellingConfig(spans=2, max_list=20)])
def test_equals_brute_force_however_lists_are_cut(spark, made, cfg):
    want = brute(made)
    assert len(want) > 100 and any(form and root != form for form, root, *_ in want.values())
    assert told(spelling.variants(spark.createDataFrame(made, "doc_id long, text string"), cfg)) == want


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert told(spelling.variants(odd_docs)) == brute(rows)
    assert told(spelling.variants(no_docs)) == {}
    long_words = [(None, "é" * 3000 + " ü" * 4), (None, "é" * 3000), (None, "é" * 3000 + "x"), (7, "Tests tests TESTS testz testz testz ÄTEST"),
                  (7, ("é" * 3000 + "x ") * 6)]
    assert told(spelling.variants(spark.createDataFrame(long_words, "doc_id long, text string"))) == brute(long_words)
