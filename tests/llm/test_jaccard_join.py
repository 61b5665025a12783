from __future__ import annotations

import random
import re

import pytest

from rowjudge.llm import jaccard_join as J


def sets_of(rows):
    out = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        out[i] = {tuple(words[k: k + 5]) for k in range(max(len(words) - 4, 1))} if words else set()
    return out


def brute(rows):
    sets, root = sets_of(rows), {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def ours(spark, rows, cfg):
    got = J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), cfg).collect()
    assert len(got) == len(rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def corpus(seed: int, n: int, vocabulary: int, longest: int):
    """Base texts, chains of edits of them, shared passages and short texts near the threshold."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(12)]
    texts: list[list[str]] = []
    while len(texts) < n:
        kind = rng.random()
        if texts and kind < 0.6:
            text = list(rng.choice(texts))
            for _ in range(rng.randint(0, 2)):
                at = rng.randint(0, len(text))
                text[at: at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
        elif kind < 0.75:
            text = [rng.choice(words) for _ in range(rng.randint(0, 20))] + passage
        else:
            text = [rng.choice(words) for _ in range(rng.randint(0, longest))]
        texts.append(text)
    return [(i * 3 % (n * 3 + 1), " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, longest, cfg", [
    (1, 14, J.JoinConfig()),  # nearly all sets are small
    (2, 60, J.JoinConfig(common=3, block=4, bucket_rows=50)),  # many common shingles, lists in blocks
    (3, 60, J.JoinConfig(largest_small=0, stars=0)),  # inverted lists alone
])
def test_equals_brute_force(spark, seed, longest, cfg):
    rows = corpus(seed, 160, 40, longest)
    assert ours(spark, rows, cfg) == brute(rows)


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(120)] = f"edit{i}"
        rows.append((i, " ".join(text)))
    assert ours(spark, rows, J.JoinConfig()) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    got = J.jaccard_classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by[1] == (0, 1) and by[3] == (0, 3) and by[8] == (1, 8) and by[9] == (1, 8)
    assert by[5] == (56, 5) and by[6] == (57, 5) and by[7] == (56, 5) and by[12] == (6, 12) and by[13] == (7, 12)
    assert J.jaccard_classes(no_docs).count() == 0


def test_the_boundary_follows_the_costs():
    cfg = J.JoinConfig()
    assert J.boundary({}, cfg) == 0
    assert J.boundary({1: 1000, 4: 1000}, cfg) >= 4
    assert J.boundary({12: 1000}, cfg) < 12 <= J.boundary({12: 1000}, J.JoinConfig(list_cost=1000))


def test_sketches_never_exceed_the_difference():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 500, rng.integers(1, 300)).astype(np.uint64) * np.uint64(977)) for _ in range(2))
        x, y = (np.frombuffer(J._sketch(s), "<u8") for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_packed_arrays_come_back():
    import numpy as np

    values = np.unique(np.random.default_rng(2).integers(0, 2**32, 5000)).astype(np.uint32)
    assert (J._unpack(J._pack(values)) == values).all()


@pytest.mark.parametrize("n", [6, 8, 60])
def test_rows_that_repeat_an_id_with_another_text_lose_no_link(spark, n):
    a, b = (" ".join(f"{w}{i}" for i in range(n)) for w in ("ant", "bee"))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (9, b)]
    got = J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = n >= 8  # two of three shingles are not enough, four of five are
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (1, 1), (2, 1 if linked else 2), (3, 1 if linked else 3), (9, 1)]
