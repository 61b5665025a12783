from __future__ import annotations

import corpus_pipeline
from rowjudge.llm import pii, quality
from rowjudge.llm.common import stored
from tests.llm.test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def test_stages_on_real_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = stored(corpus_pipeline.keep_quality(spark, docs, SF), "kept")
    cfg = quality.QualityConfig()
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    assert all(i in ids for i, q in labels.items() if q == 1 and cfg.threshold < 0.5)
    distinct = stored(corpus_pipeline.keep_distinct(spark, kept, SF), "distinct")
    classes = brute([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert {r["doc_id"] for r in distinct.collect()} == {i for i, (_, c) in classes.items() if i == c}
    masked = corpus_pipeline.mask_personal_data(spark, distinct, SF).collect()
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in masked)


def test_odd_rows_pass_through_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns and out.schema == docs.schema
            out.collect()
    kept = corpus_pipeline.keep_distinct(spark, odd_docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 2, 3, 4, 5, 8, 10, 11, 12, 14]
    assert sorted(str(r["text"]) for r in kept if r["doc_id"] is None) == ["None", "no id at all here"]


def test_run_gives_packed_pieces(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_unlike_documents_with_one_id_both_stay(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(30)) for w in ("ant", "bee"))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, ""), (4, " "), (4, ""), (5, None), (4, a)]
    kept = corpus_pipeline.keep_distinct(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == sorted([(1, a), (1, b), (4, ""), (4, " "), (5, "")])
