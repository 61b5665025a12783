"""WARC archives with revisit records, and their capture index by external merge.

1. Write: payload digests are counted first (no payload moves): of equal payloads of at least ``min_bytes`` that with the
   largest page id is the response, the others become revisit records without a payload. Records are dealt to archives of
   about ``archive_bytes`` and sorted in each by URL key, time and id, so every archive is a locally sorted capture run.
   Spark's own writer lays the records into gzip files: on any file system, committed by task. Offsets are those of the
   unpacked archive.
2. Read: each archive is parsed by its content lengths, payloads are digested again and held against their headers.
3. Merge: the runs' index rows are range-partitioned by (URL key, time, id) into ranges of about ``merge_rows``, and each
   range merges its part of all runs with a loser tree: the ranges, one after the other, are the globally ordered history, in
   which ``capture_history`` gives each capture its place.

Null payloads count as empty, null URLs as the empty key. Rows that repeat an id with an equal payload are responses alike
if the id is the largest. A null id is never the largest; where all ids of a payload are null, all are responses. An empty
table gives no records. Other columns are not read. A record has to fit in a task's memory, an archive too.
"""

from __future__ import annotations

import gzip
import hashlib
import math
import re
import uuid
from base64 import b32encode
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowjudge.llm.common import stored
from rowjudge.sources.files import scratch_dir


@dataclass(frozen=True)
class WarcConfig:
    min_bytes: int = 0
    archive_bytes: int = 16 << 20
    merge_rows: int = 50_000


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 bytes: 40 bits make 8 of the 32 digits."""
    digest = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query: pages of a host, and hosts of a domain, are neighbours."""
    low = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\.", "")
    rest = F.regexp_replace(F.regexp_replace(low, r"^[a-z][a-z0-9+.-]*://[^/?#]*", ""), r"#.*$", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _iso(digits: Column) -> Column:
    """Fourteen digits as the date of a header."""
    parts = [(1, 4, ""), (5, 2, "-"), (7, 2, "-"), (9, 2, "T"), (11, 2, ":"), (13, 2, ":")]
    return F.concat(*[F.concat(F.lit(before), F.substring(digits, at, n)) for at, n, before in parts], F.lit("Z"))


def _one_line(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(value, F.lit("")), "\r", "%0D"), "\n", "%0A")


def write_archives(pages: DataFrame, path: str, cfg: WarcConfig = WarcConfig()) -> None:
    """Writes ``pages`` (page_id, url, payload, captured: 14 digits) as WARC files under ``path``."""
    rows = pages.select("page_id", "url", F.coalesce("payload", F.lit("")).alias("payload"),
                        F.coalesce("captured", F.lit("")).alias("captured"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload"))
    facts = stored(rows.select("page_id", "digest", F.col("bytes").cast("long").alias("bytes")), "payloads")
    total = facts.agg(F.sum(F.col("bytes") + 600)).first()[0] or 1
    archives = max(1, math.ceil(total / cfg.archive_bytes))
    last = facts.where(F.col("bytes") >= cfg.min_bytes).groupBy("digest").agg(F.max("page_id").alias("last"))
    revisits = facts.join(last, "digest").where("page_id IS DISTINCT FROM last AND last IS NOT NULL")
    own = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_own")
    revisits = revisits.select(own, "digest", "last").distinct()
    # one shuffle of the payloads: into archives by what the join with the small table of revisits needs anyway
    dealt = rows.select("*", own).repartition(archives, "_own", "digest")
    told = dealt.join(revisits, ["_own", "digest"], "left")
    again = F.col("last").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"), F.lit("\r\nWARC-Date: "), _iso(F.col("captured")),
        F.lit("\r\nWARC-Target-URI: "), _one_line(F.col("url")), F.lit("\r\nWARC-Target-Key: "), _one_line(F.col("key")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                     "\r\nWARC-Refers-To: "), name("last"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), F.col("block"))
    laid = told.withColumn("key", url_key(F.col("url"))).withColumn("block", block)
    ordered = laid.sortWithinPartitions("key", "captured", "page_id").select(value.alias("value"))
    ordered.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)  # a record ends with two line ends


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    at = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
        end = head + int(fields["Content-Length"])
        body = data.index(b"\r\n\r\n", head, end) + 4
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        sent = next(x for x in data[head:body].decode().split("\r\n") if x.startswith("Content-Length: "))
        n = int(sent.removeprefix("Content-Length: "))
        if kind == "response" and (end - body != n or b32encode(hashlib.sha1(data[body:end]).digest()).decode() != digest):
            raise ValueError(f"the payload at byte {body} is not what its header says")
        if data[end: end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is cut")
        number = lambda name: int(fields[name][10:-1]) if fields.get(name, "<urn:page:>") != "<urn:page:>" else None
        yield {"url_key": fields.get("WARC-Target-Key", ""), "captured": re.sub(r"\D", "", fields["WARC-Date"]), "page_id": number("WARC-Record-ID"),
               "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": number("WARC-Refers-To"),
               "start": at, "length": end + 4 - at}
        at = end + 4


_INDEX = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, " \
         "refers_to long, start long, length long"
_NAMES = [x.split()[0] for x in _INDEX.split(", ")]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The capture index of the archives under ``path``: per record its fields, its archive and its number there."""
    def run(batches):
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"]):
                found = pd.DataFrame(list(parse(gzip.decompress(data))), columns=_NAMES)
                for c in ("page_id", "refers_to"):
                    found[c] = found[c].astype("Int64")
                if len(found):
                    yield found.assign(archive=name.rsplit("/", 1)[-1], number=range(len(found)))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, f"{_INDEX}, archive string, number long")


def loser_tree(runs: list[Iterable[tuple]]) -> Iterator[tuple]:
    """Merges sorted runs: the tree's nodes hold the losers of their matches, so each item costs one climb to the root."""
    sources = [iter(r) for r in runs]
    k = len(sources)
    heads = [next(s, None) for s in sources]
    losers = [-1] * max(k, 1)

    def beats(x: int, y: int) -> bool:
        if heads[x] is None or heads[y] is None:
            return heads[y] is None and (heads[x] is not None or x < y)
        return (heads[x], x) < (heads[y], y)

    def climb(x: int) -> int:
        node = (x + k) // 2
        while node:
            if losers[node] < 0:  # the first to arrive waits for its match
                losers[node] = x
                return -1
            if beats(losers[node], x):
                losers[node], x = x, losers[node]
            node //= 2
        return x

    winner = -1
    for i in range(k):
        winner = max(winner, climb(i))
    while k and heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        winner = climb(winner)


def merge_index(index: DataFrame, cfg: WarcConfig = WarcConfig()) -> DataFrame:
    """The index in global order: by ``range_id``, then ``position``."""
    index = stored(index, "captures")
    ranges = max(1, math.ceil(index.count() / cfg.merge_rows))

    def run(batches):
        parts = [pdf for pdf in batches if len(pdf)]  # one range: about merge_rows
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        ids = rows["page_id"].fillna(-(2**63)).astype("int64")
        keys = list(zip(rows["url_key"], rows["captured"], ids, rows.index))
        cuts = rows.index[rows["archive"].ne(rows["archive"].shift())].tolist() + [len(rows)]
        order = [key[3] for key in loser_tree([keys[a:b] for a, b in zip(cuts, cuts[1:])])]
        yield rows.iloc[order].assign(range_id=TaskContext.get().partitionId(), position=range(len(rows)))

    ranged = index.repartitionByRange(ranges, "url_key", "captured", "page_id").sortWithinPartitions("archive", "number")
    return ranged.mapInPandas(run, f"{_INDEX}, archive string, number long, range_id int, position long")


def archive_and_index(pages: DataFrame, cfg: WarcConfig = WarcConfig()) -> DataFrame:
    """Writes the archives into the shared scratch folder, reads them back and merges their captures."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, cfg)
    return merge_index(read_archives(spark, path), cfg)


def capture_history(merged: DataFrame) -> DataFrame:
    """``merge_index``'s rows with ``place``: the number of captures before each in the whole history."""
    merged = stored(merged, "history")
    sizes = merged.groupBy("range_id").agg(F.count("*").alias("n"))  # one row for each range
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("range_id", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("shift"))
    return merged.join(shift, "range_id").withColumn("place", F.col("shift") + F.col("position")).drop("shift")
