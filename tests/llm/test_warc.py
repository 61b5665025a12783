from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowjudge.llm import warc


def test_loser_tree_merges():
    rng = random.Random(1)
    for _ in range(300):
        runs = [sorted((rng.randint(0, 9), rng.random()) for _ in range(rng.randint(0, 7))) for _ in range(rng.randint(0, 9))]
        assert list(warc.loser_tree(runs)) == sorted(x for r in runs for x in r)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://www.b.org/x?q=1#f", "same", "20240101000000"), (5, "https://a.org/", "same", "20240102000000"),
            (3, None, None, "20240101000000"), (4, "http://a.org/\r\nWARC-Type: x", "", "20230101000000"),
            (6, "http://a.org/", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n é", "20250101000000"),
            (7, "http://a.org/", "once", "20200101000000"), (7, "http://a.org/", "once", "20200101000000"), (None, "u", "same", "20240101000000")]
    return spark.createDataFrame(rows, "page_id long, url string, payload string, captured string")


def test_round_trip_and_revisits(pages):
    rows = warc.archive_and_index(pages, warc.WarcConfig(archive_bytes=700, merge_rows=3)).collect()
    assert len(rows) == 8
    by = {r["page_id"]: r for r in rows}
    assert (by[5]["record_type"], by[5]["refers_to"]) == ("response", None)
    assert (by[1]["record_type"], by[1]["refers_to"], by[1]["payload_bytes"]) == ("revisit", 5, 4)
    assert (by[None]["record_type"], by[None]["refers_to"]) == ("revisit", 5)
    assert (by[3]["record_type"], by[3]["refers_to"]) == ("revisit", 4) and by[4]["record_type"] == "response"
    assert [r["record_type"] for r in rows if r["page_id"] == 7] == ["response"] * 2
    assert by[4]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_global_order(pages):
    rows = sorted(warc.archive_and_index(pages, warc.WarcConfig(archive_bytes=500, merge_rows=2)).collect(), key=lambda r: (r["range_id"], r["position"]))
    keys = [(r["url_key"], r["captured"], r["page_id"] if r["page_id"] is not None else -(2**63)) for r in rows]
    assert keys == sorted(keys)
    told = warc.capture_history(warc.archive_and_index(pages, warc.WarcConfig(archive_bytes=500, merge_rows=2))).collect()
    assert sorted(r["place"] for r in told) == list(range(len(rows)))
    told.sort(key=lambda r: r["place"])
    assert [(r["url_key"], r["captured"]) for r in told] == [k[:2] for k in keys]


def test_small_payloads_are_all_responses(pages):
    rows = warc.archive_and_index(pages, warc.WarcConfig(min_bytes=10)).collect()
    assert {r["record_type"] for r in rows} == {"response"}


def test_no_pages(pages):
    assert warc.archive_and_index(pages.where("false")).count() == 0


def test_url_key(spark):
    url = spark.createDataFrame([("HTTP://u:p@WWW.Example.com:80/A?b#c",)], "u string")
    assert url.select(warc.url_key(F.col("u"))).first()[0] == "com,example)/a?b"
