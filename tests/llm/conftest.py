from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, component_id string, _row int, pos int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null, empty, very long, repeated and tied rows, and columns whose names the operators use themselves."""
    long_text = " ".join(f"word{i % 997} of{i}" for i in range(30_000))
    near = " ".join(f"alpha{i}" for i in range(60))
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "   \n\t ", "en", "b"), (4, long_text, "en", "a"),
        (5, near, "de", "c"), (6, near + " omega", "de", "c"), (7, near, None, None), (7, near, None, None),
        (8, "one two three", "fr", "b"), (9, "ONE two three", "fr", "b"), (10, "mail bob@example.com or +1 (555) 123-4567 now", "en", "a"),
        (None, "no id at all here", "en", None), (None, None, None, None), (11, "é" * 5000, "fr", "a"),
        (12, "a b c d e f g h i j", "en", "c"), (13, "a b c d e f g h i j k", "en", "c"), (14, "1" * 40_000, None, "a"),
    ]
    return spark.createDataFrame([(i, t, la, so, len(t) if t else None, 1, 0.5, "x", 7, 9) for i, t, la, so in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
