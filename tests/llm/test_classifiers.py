from __future__ import annotations

import random

import numpy as np

from rowjudge.llm import language, quality
from rowjudge.llm.queries import QUERIES
from rowjudge.sources.tables import table

SF = "/root/testdata/sf0.01"


def test_held_out_quality(spark):
    got = QUERIES["op6_quality"](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in got)
    assert right >= 0.9 * len(got) > 30 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == 1 for r in got if r["quality"] == 1)  # clean documents stay


def test_scores_are_sparse_dot_products(spark):
    cfg = quality.QualityConfig(bits=10)
    weights = np.random.default_rng(1).normal(size=(1 << 10) + 1 + quality.SHARES)
    for text in ("", "One two, two three!", "é é é " * 50):
        place, value = quality.features(text, 10)
        assert len(set(place.tolist())) == len(place) and place[0] == 0
        got = quality.score(spark.createDataFrame([(text,)], "text string"), weights, cfg).first()["score"]
        assert abs(got - 1 / (1 + np.exp(-sum(weights[p] * v for p, v in zip(place, value))))) < 1e-12


def test_updates_equal_the_stated_rule():
    """One coordinate at a time, as the method is published."""
    cfg = quality.QualityConfig(bits=4)
    model, z, n = quality.Ftrl(cfg), {}, {}
    rng = random.Random(2)

    def weight(i):
        if abs(z.get(i, 0)) <= cfg.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * cfg.l1) / ((cfg.beta + n[i] ** 0.5) / cfg.alpha + cfg.l2)

    for _ in range(60):
        place = np.array(sorted(rng.sample(range(16), 5)))
        value, label = np.array([rng.random() for _ in place]), float(rng.random() < 0.5)
        p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in zip(place, value))))
        step = {}
        for i, v in zip(place.tolist(), value):
            g = (p - label) * v * (1 if label else cfg.negative_weight)
            sigma = ((n.get(i, 0) + g * g) ** 0.5 - n.get(i, 0) ** 0.5) / cfg.alpha
            step[i] = (g - sigma * weight(i), g * g)
        for i, (dz, dn) in step.items():
            z[i], n[i] = z.get(i, 0) + dz, n.get(i, 0) + dn
        model.learn(place, value, label)
    assert np.allclose(model.weight(np.arange(16)), [weight(i) for i in range(16)])


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (7, 0), (8, None), (9, 7), (99, 1), (None, 1)], "doc_id long, label int")
    cfg = quality.QualityConfig()
    got = quality.score(odd_docs, quality.train(odd_docs, labels, cfg), cfg, "p").collect()
    assert len(got) == odd_docs.count() and all(0 <= r["p"] <= 1 for r in got)
    assert len({r["p"] for r in got if r["text"] in (None, "")}) == 1
    none = quality.train(odd_docs, labels.where("false"), cfg)
    assert {r["p"] for r in quality.score(odd_docs, none, cfg, "p").collect()} == {0.5}
    assert quality.score(no_docs, none, cfg, "p").count() == 0


def test_held_out_languages(spark):
    got = QUERIES["op8_language"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got) > 150


def test_language_odd_rows(odd_docs, no_docs):
    known = language.dictionaries(odd_docs.select("text", "lang"))
    assert {name for name, _ in known} == {"en", "de", "fr"}
    got = language.predict(odd_docs.select("doc_id", "text"), known).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(by[i]["lang_pred"] == "und" and by[i]["rejected"] for i in (1, 2, 3, 14)) and by[7]["lang_pred"] == "de"
    assert language.dictionaries(no_docs.select("text", "lang")) == []
    assert {r["lang_pred"] for r in language.predict(odd_docs.select("doc_id", "text"), []).collect()} == {"und"}


def test_smallest_sum_wins(spark):
    """Brute force: the sizes of all chunks under all dictionaries, for what predict gives."""
    known = [("x", b"lorem ipsum dolor sit amet " * 50), ("y", b"quick brown fox jumps over " * 50), ("z", b"und der die das nicht " * 60)]
    texts = ["The QUICK brown fox, jumps over 12 lorem!", "lorem ipsum", "Das ist nicht der Fuchs", "quick lorem " * 2000, "12 34", None, "é"]
    cfg = language.LanguageConfig(chunk=64)
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in enumerate(texts)], "doc_id long, text string, score double, Lang_Pred string")
    out = language.predict(docs, known, cfg)
    assert out.columns == ["doc_id", "lang_pred", "score", "rejected"]
    got = {r["doc_id"]: r for r in out.collect()}
    packers = [language._compressor(d) for _, d in known]
    for i, text in enumerate(texts):
        data = language.letters(text or "").encode()
        if not data:
            assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
            continue
        sizes = [sum(len(p.compress(data[at:at + 64])) for at in range(0, len(data), 64)) for p in packers]
        best = sizes.index(min(sizes))
        assert got[i]["lang_pred"] == known[best][0] and got[i]["rejected"] == (sorted(sizes)[1] < 1.01 * sizes[best])


def test_a_dictionary_takes_slices_until_it_is_full(spark):
    docs = spark.createDataFrame([(f"wort{chr(97 + i % 26)}{i} " * 60, "de") for i in range(50)], "text string, lang string")
    whole, = language.dictionaries(docs, language.LanguageConfig(samples=50, salts=2))
    short, = language.dictionaries(docs, language.LanguageConfig(samples=50, salts=2, dictionary_bytes=2_000))
    assert len(short[1]) <= 2_000 < len(whole[1]) and whole[1].startswith(short[1]) and short[1].endswith(b" ")
