from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rowjudge.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
CFG = packing.PackConfig(PATH)


def laid(runs) -> dict[int, list[tuple[int, int]]]:
    out: dict[int, list[tuple[int, int]]] = {}
    for r in runs.itertuples():
        for i in range(r.count):
            out.setdefault(r.sequence + i, []).append((r.offset, r.length))
    return out


def best_fit_decreasing(counts) -> int:
    """Brute force, item by item."""
    gaps, used = [0] * 1025, 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            gap = next((g for g in range(length, 1025) if gaps[g]), None)
            used += gap is None
            if gap is not None:
                gaps[gap] -= 1
            gaps[(gap or 1024) - length] += 1
    return used


@pytest.mark.parametrize("n", [0, 1, 2, 30, 700, 5000])
@pytest.mark.parametrize("kind", ["even", "short", "few"])
def test_a_plan_places_every_piece_once(n, kind):
    rng = random.Random(f"{n}{kind}")
    draw = {"even": lambda: rng.randint(1, 1024), "short": lambda: min(1024, 1 + int(rng.expovariate(1 / 250))),
            "few": lambda: rng.choice([1024, 512, 511, 400, 342, 341, 7])}[kind]
    counts: dict[int, int] = {}
    for _ in range(n):
        size = draw()
        counts[size] = counts.get(size, 0) + 1
    runs = packing.plan(counts, CFG)
    for length, total in counts.items():
        own = runs[runs["length"] == length]
        assert list(own["first"]) == [0, *np.cumsum(own["count"])[:-1]] and own["count"].sum() == total
    sequences = laid(runs)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.02 * best_fit_decreasing(counts) + 3


def test_configurations_meet_the_known_optimum():
    """Three sizes that fit as pairs and triples: the program finds the full patterns."""
    found = packing.configurations([600, 424, 341], np.array([90.0, 90.0, 30.0]), 1024)
    assert abs(sum(level for _, level in found) - 100) < 0.1


def test_ids_equal_the_tokenizers_library():
    own, theirs = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(5)
    parts = ["a", "The", " ", "  ", "\n", "\t", "\r\n", "é", "日本", "12", "'s", "!!", " ", "　", "½", "<|endoftext|>", "\x1c", "👍"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert list(own.encode(text)) == theirs.encode(text, add_special_tokens=False).ids, text
    assert list(own.encode("a <|endoftext|> b")) == theirs.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]


def test_other_files_are_read_by_their_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert list(packing.Encoder(path).encode("Hello there")) == Tokenizer.from_file(path).encode("Hello there", add_special_tokens=False).ids


def test_odd_rows(odd_docs, no_docs):
    rows = packing.pack(odd_docs, CFG).collect()
    theirs = Tokenizer.from_file(PATH)
    want = []
    for r in odd_docs.collect():
        ids = np.array(theirs.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [(r["doc_id"], i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in rows)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        assert [o for o, _ in sorted(pieces)] == [0, *np.cumsum([n for _, n in sorted(pieces)])[:-1]]
    assert packing.pack(no_docs, CFG).count() == 0
