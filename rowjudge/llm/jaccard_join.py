"""N-gram Jaccard join: documents whose word shingle sets overlap by ``percent`` of their union, and the classes they form.

A size-aware join with a heavy and a light side:

1. Shingles are counted over all texts, packed as sorted arrays in every task. The most frequent ones (above ``common``
   documents, at most ``max_common``) come last in the global order, by frequency class; the order decides work, not results.
2. One pass gives each document's set size, a 128-bit digest of its set, its prefix in that order, and a sketch (one parity bit for
   each of 1,024 buckets, whose differences never exceed the sets' difference). Equal sets become one.
3. Small sets list all subsets of the sizes that a partner of each size must share; a common subset is a link. The boundary is
   the size at which the subsets of all smaller sets and the inverted lists of the others cost least.
4. Larger sets scan inverted lists of the prefixes, where every linked pair meets. Lists first link their members to one
   of them in each of ``stars`` rounds, by a different choice each: large groups of near copies become one class that way.
   Then all pairs of different classes in a list are tried, in blocks. A pair is sent on only if sizes and sketches allow it,
   and compared exactly.
5. Classes are the connected components of the links.

Null texts count as empty. Without words a document's set is empty and links with nothing. Repeated rows have equal sets; rows that
repeat an id with another text are sets of their own. An empty table gives no rows. Other columns are not read. A null id belongs to the class of its set but never names it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from rowjudge.llm.common import components, conf_partitions, discard, released, stored, text_of


@dataclass(frozen=True)
class JoinConfig:
    """common: a shingle in more documents is common; max_common: bound of the list of common ones (5 bytes each);
    list_cost: what an entry of an inverted list costs, in subsets; largest_small: no boundary beyond."""

    words: int = 5
    percent: int = 80
    common: int = 20
    max_common: int = 1 << 20
    list_cost: int = 8
    largest_small: int = 16
    stars: int = 3
    bucket_rows: int = 500_000
    block: int = 2048


# -- sets ---------------------------------------------------------------------------------------

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles. Splitting bytes at white space and lowering them touches ASCII only."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    word = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    n = min(words, len(word))
    out = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        out ^= word[i: len(word) - n + 1 + i]
        out *= _MIX
        out ^= out >> np.uint64(32)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


def least_overlap(s: int, t: int, percent: int) -> int:
    """The smallest intersection at which sets of these sizes link."""
    return -(-percent * (s + t) // (100 + percent))


def partner_sizes(s: int, percent: int) -> range:
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def _prefix_length(n: np.ndarray, percent: int):
    return n - -(-percent * n // 100) + 1


def _sketch(tokens: np.ndarray) -> bytes:
    return np.packbits((np.bincount((tokens & np.uint64(1023)).astype(np.int64), minlength=1024) & 1).astype(np.uint8)).tobytes()


def _slices(batches, rows: int = 512):
    """Arrow batches in pieces, so that a worker holds few texts as Python objects."""
    for batch in released(batches):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# -- common shingles ----------------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """A sorted array of 32-bit numbers as compressed differences, byte plane by byte plane."""
    steps = np.diff(values.astype(np.int64), prepend=0).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)).astype(np.uint32)


def _counter(cfg: JoinConfig, ranges: int):
    edges = np.linspace(0, 2**32, ranges + 1).astype(np.int64)

    def flush(kept):
        key, count = np.unique(np.concatenate(kept), return_counts=True)
        cut = np.searchsorted(key, edges)
        rows = [(r, _pack(key[a:b]), zstandard.compress(count[a:b].astype("<u4").tobytes(), 1))
                for r, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.binary()),
                                           pa.array([x[2] for x in rows], pa.binary())], names=["range", "keys", "counts"])

    def run(batches):
        kept, n = [], 0
        for batch in _slices(batches):
            for text in batch.column(0).to_pylist():
                tokens = shingles(text, cfg.words)
                kept.append((tokens >> np.uint64(32)).astype(np.uint32))
                n += len(tokens)
                if n > 2_000_000:
                    yield flush(kept)
                    kept, n = [], 0
        if n:
            yield flush(kept)

    return run


def _classes(cfg: JoinConfig):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([_unpack(k) for k in pdf["keys"]])
        count = np.concatenate([np.frombuffer(zstandard.decompress(c), "<u4") for c in pdf["counts"]])
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        key, count = key[start], np.add.reduceat(count.astype(np.int64), start)
        often = count > cfg.common
        key, kind = key[often], np.ceil(np.log2(count[often])).astype(np.uint8)
        return pd.DataFrame({"keys": [key.astype("<u4").tobytes()], "kinds": [kind.tobytes()],
                             "sizes": [np.bincount(kind, minlength=64).tolist()]})

    return run


def common_shingles(docs: DataFrame, cfg: JoinConfig) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (the upper 32 bits) of the common shingles and their frequency classes; at most ``max_common`` of them."""
    ranges = max(16, conf_partitions(docs.sparkSession))
    packed = docs.select("text").mapInArrow(_counter(cfg, ranges), "range int, keys binary, counts binary")
    found = stored(packed.groupBy("range").applyInPandas(_classes(cfg), "keys binary, kinds binary, sizes array<long>"), "common")
    sizes = np.zeros(64, np.int64)
    for r in found.select("sizes").collect():  # 64 numbers for each range
        sizes += np.array(r["sizes"])
    above = np.cumsum(sizes[::-1])[::-1]
    least = next(k for k in range(65) if k == 64 or above[k] <= cfg.max_common)

    def keep(batches):
        for pdf in batches:
            rows = []
            for keys, kinds in zip(pdf["keys"], pdf["kinds"]):
                kind = np.frombuffer(kinds, np.uint8)
                rows.append((np.frombuffer(keys, "<u4")[kind >= least].tobytes(), kind[kind >= least].tobytes()))
            yield pd.DataFrame(rows, columns=["keys", "kinds"])

    rows = found.select("keys", "kinds").mapInPandas(keep, "keys binary, kinds binary").collect()
    discard(found)
    key = np.frombuffer(b"".join(r["keys"] for r in rows), "<u4")
    kind = np.frombuffer(b"".join(r["kinds"] for r in rows), np.uint8)
    order = np.argsort(key, kind="stable")
    return key[order], kind[order]


def _class_of(tokens: np.ndarray, key: np.ndarray, kind: np.ndarray) -> np.ndarray:
    if not len(key):
        return np.zeros(len(tokens), np.uint8)
    upper = (tokens >> np.uint64(32)).astype(np.uint32)
    at = np.minimum(np.searchsorted(key, upper), len(key) - 1)
    return np.where(key[at] == upper, kind[at], 0)


# -- one row for each document --------------------------------------------------------------------

def _describe(cfg: JoinConfig, key: np.ndarray, kind: np.ndarray):
    def run(batches):
        for batch in _slices(batches):
            rows = []
            for text in batch.column(2).to_pylist():
                tokens = shingles(text, cfg.words)
                n = len(tokens)
                if not n:
                    rows.append((0, 0, 0, b"", b"", b""))
                    continue
                digest = np.frombuffer(xxh3_128_digest(tokens.tobytes()), "<i8")
                rare = _class_of(tokens, key, kind)
                first = np.lexsort((tokens, rare))[: _prefix_length(n, cfg.percent)]
                rows.append((n, int(digest[0]), int(digest[1]), tokens[first].tobytes(), rare[first].tobytes(), _sketch(tokens)))
            cols = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)] + [pa.array(list(c), t) for c, t in zip(cols, types)],
                                             names=["doc_id", "tag", "n", "h1", "h2", "prefix", "rare", "sketch"])
    return run


# -- small sets -----------------------------------------------------------------------------------

def subset_count(s: int, cfg: JoinConfig) -> int:
    return sum(math.comb(s, least_overlap(s, t, cfg.percent)) for t in partner_sizes(s, cfg.percent))


def boundary(sizes: dict[int, int], cfg: JoinConfig) -> int:
    """The largest small size: least subsets of the small sets plus list entries of the others."""
    def cost(b: int) -> int:
        light = sum(n * subset_count(s, cfg) for s, n in sizes.items() if s <= b)
        heavy = sum(n * cfg.list_cost * int(_prefix_length(s, cfg.percent)) for s, n in sizes.items() if s in partner_sizes(b + 1, cfg.percent) or s > b)
        return light + heavy

    return min(range(cfg.largest_small + 1), key=lambda b: (cost(b), b))


def _subsets(cfg: JoinConfig, small: int):
    def run(batches):
        for batch in _slices(batches):
            out = ([], [], [], [])
            for own, h1, h2, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                tokens = shingles(text, cfg.words)
                s = len(tokens)
                if tuple(np.frombuffer(xxh3_128_digest(tokens.tobytes()), "<i8")) != (h1, h2):
                    continue  # another text of the same document id
                for t in partner_sizes(s, cfg.percent):
                    if t <= small:
                        for part in combinations(tokens.tolist(), least_overlap(s, t, cfg.percent)):
                            d = np.frombuffer(xxh3_128_digest(np.array([min(s, t), max(s, t), *part], np.uint64).tobytes()), "<i8")
                            for column, value in zip(out, (int(d[0]), int(d[1]), own, s <= t)):
                                column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                                             names=["k1", "k2", "id", "lower"])
    return run


def small_links(texts: DataFrame, cfg: JoinConfig, small: int) -> DataFrame:
    """Links (a, b) among small sets, from ``texts`` (id, h1, h2, text): who shares a subset links with the smallest id of the lower
    size. ``h1`` and ``h2`` tell the set's own text from others of its document id."""
    rows = stored(texts.mapInArrow(_subsets(cfg, small), "k1 long, k2 long, id long, lower boolean"), "subsets")
    centre = rows.groupBy("k1", "k2").agg(F.min(F.when(F.col("lower"), F.col("id"))).alias("b"), F.count("*").alias("m")).where("m > 1 AND b IS NOT NULL")
    links = stored(rows.join(centre, ["k1", "k2"]).where("id <> b").select(F.col("id").alias("a"), "b").distinct(), "links")
    discard(rows)
    return links


# -- inverted lists -------------------------------------------------------------------------------

def _postings(buckets: int):
    """Prefix entries of light shingles, packed by bucket; those of common ones as they are (bucket -1)."""
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            token = [np.frombuffer(p, "<u8") for p in pdf["prefix"]]
            rare = np.concatenate([np.frombuffer(r, np.uint8) for r in pdf["rare"]])
            own = np.repeat(pdf["id"].to_numpy(), [len(t) for t in token])
            token = np.concatenate(token)
            bucket = np.where(rare > 0, -1, (token % np.uint64(buckets)).astype(np.int64))
            order = np.lexsort((token, bucket))
            bucket, token, own = bucket[order], token[order], own[order]
            start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            ends = np.r_[start[1:], len(bucket)]
            yield pd.DataFrame({"bucket": bucket[start], "tokens": [token[a:b].tobytes() for a, b in zip(start, ends)],
                                "ids": [own[a:b].astype("<i8").tobytes() for a, b in zip(start, ends)]})
    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    token = np.frombuffer(b"".join(pdf["tokens"]), "<u8")
    own = np.frombuffer(b"".join(pdf["ids"]), "<i8")
    order = np.argsort(token, kind="stable")
    token, own = token[order], own[order]
    same = token[1:] == token[:-1]
    often = np.r_[False, same] | np.r_[same, False]
    return pd.DataFrame({"token": token[often].view(np.int64), "id": own[often], "common": False})


def _unpacked(batches):
    for pdf in batches:
        for tokens, ids in zip(pdf["tokens"], pdf["ids"]):
            yield pd.DataFrame({"token": np.frombuffer(tokens, "<i8"), "id": np.frombuffer(ids, "<i8"), "common": True})


def inverted_lists(sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """(token, id, common): the entries of lists that may hold two sets and more, from ``sets`` (id, n, prefix, rare)."""
    total = sets.agg(F.sum(F.length("rare"))).first()[0] or 0
    buckets = max(1, total // cfg.bucket_rows)
    packed = sets.select("id", "prefix", "rare").mapInPandas(_postings(buckets), "bucket long, tokens binary, ids binary")
    schema = "token long, id long, common boolean"
    light = packed.where("bucket >= 0").groupBy("bucket").applyInPandas(_shared, schema)
    return stored(light.union(packed.where("bucket < 0").mapInPandas(_unpacked, schema)), "lists")


def _may_link(percent: int):
    """Sizes and sketches allow a link: the sets differ in at least as many shingles as their sketches in bits."""
    most = F.floor((100 - percent) * (F.col("na") + F.col("nb")) / (100 + percent))
    fits = (F.lit(percent) * F.greatest("na", "nb") <= 100 * F.least("na", "nb"))

    @F.pandas_udf("int")
    def differ(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), "<u8").reshape(len(s), 16) for s in (a, b))
        return pd.Series(np.bitwise_count(x ^ y).sum(1).astype(np.int32))

    return fits, differ("sa", "sb") <= most


#: Bits of the filter that keeps texts nobody needs out of a shuffle.
_BITS = 1 << 24


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without most of those whose id isn't among ``ids`` (doc): a bitmap of hashed ids is broadcast, at most
    2^18 words whatever the size of the corpus. What it lets through by chance is left to the join that follows."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(_BITS))
    flag = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), (bit(c) % 64).cast("int"))
    words = ids.groupBy(F.floor(bit("doc") / 64).alias("at")).agg(F.bit_or(flag("doc")).alias("word"))
    kept = docs.join(F.broadcast(words), F.floor(bit("doc_id") / 64) == F.col("at"))
    return kept.where(F.col("word").bitwiseAND(flag("doc_id")) != 0).select("doc_id", "text")


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, compared shingle by shingle."""
    facts = sets.select("id", "n", "sketch")
    near = pairs.join(facts.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    near = near.join(facts.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    fits, alike = _may_link(cfg.percent)
    near = stored(near.where(fits).where(alike).select("a", "b"), "near")
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = stored(ids.join(sets.select("id", "doc", "h1", "h2"), "id"), "needed")

    def collect(batches):
        for batch in _slices(batches):
            own, found = [], []
            for i, h1, h2, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                tokens = shingles(text, cfg.words).tobytes()
                if tuple(np.frombuffer(xxh3_128_digest(tokens), "<i8")) == (h1, h2):  # ids may repeat with another text
                    own.append(i)
                    found.append(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(found, pa.binary())], names=["id", "tokens"])

    texts = _only(docs, ids).join(ids, F.col("doc_id") == F.col("doc")).select("id", "h1", "h2", "text")
    tokens = stored(texts.mapInArrow(collect, "id long, tokens binary").dropDuplicates(["id"]), "tokens")

    def compare(batches):
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["ta"], pdf["tb"]):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= cfg.percent * (len(x) + len(y) - both))
            yield pdf.loc[keep, ["a", "b"]]

    full = near.join(tokens.select(F.col("id").alias("a"), F.col("tokens").alias("ta")), "a")
    full = full.join(tokens.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
    links = stored(full.select("a", "b", "ta", "tb").mapInPandas(compare, "a long, b long"), "verified")
    discard(near, tokens, ids)
    return links


def _classed(lists: DataFrame, links: DataFrame | None) -> DataFrame:
    """``lists`` with each entry's class so far, without those lists that are in one class."""
    if links is None:
        classed = lists.withColumn("class", F.col("id"))
    else:
        label = components(links)
        classed = lists.join(label, F.col("id") == F.col("node"), "left").select("token", "id", "common", F.coalesce("component_id", "id").alias("class"))
    mixed = classed.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("token")
    return stored(classed.join(mixed, "token"), "classed")


def _crossing(cfg: JoinConfig):
    """Pairs of different classes in the lists of a block that sizes and sketches allow."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["token", "id"])
        own, group, n = (pdf[c].to_numpy() for c in ("id", "class", "n"))
        sketch = np.frombuffer(b"".join(pdf["sketch"]), "<u8").reshape(len(pdf), 16)
        token = pdf["token"].to_numpy()
        cuts = np.r_[np.flatnonzero(np.r_[True, token[1:] != token[:-1]]), len(token)]
        out, held = [np.zeros((0, 2), np.int64)], 0
        for a, b in zip(cuts, cuts[1:]):
            for at in range(a, b, 128):
                i, j = slice(at, min(at + 128, b)), slice(a, b)
                low, high = np.minimum(n[i, None], n[None, j]), np.maximum(n[i, None], n[None, j])
                ok = (group[i, None] != group[None, j]) & (own[i, None] < own[None, j]) & (cfg.percent * high <= 100 * low)
                x, y = np.nonzero(ok)
                for k in range(0, len(x), 65536):
                    p, q = x[k: k + 65536] + at, y[k: k + 65536] + a
                    differ = np.bitwise_count(sketch[p] ^ sketch[q]).sum(1)
                    near = differ <= (100 - cfg.percent) * (n[p] + n[q]) // (100 + cfg.percent)
                    out.append(np.stack([own[p[near]], own[q[near]]], axis=1))
                    held += len(out[-1])
                    if held > 1_000_000:  # the same pair meets in many lists
                        out, held = [np.unique(np.concatenate(out), axis=0)], 0
        found = np.unique(np.concatenate(out), axis=0)
        return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return run


def _cross_pairs(left: DataFrame, sets: DataFrame, cfg: JoinConfig) -> DataFrame:
    """Light lists by bucket, common lists by pairs of blocks of their members."""
    entries = stored(left.join(sets.select("id", "n", "sketch"), "id"), "entries")
    buckets = max(1, entries.count() // 4_096)
    light = entries.where("NOT common").withColumn("key", F.pmod(F.xxhash64("token"), F.lit(buckets))).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    common = entries.where("common")
    blocks = common.groupBy("token").agg(F.ceil(F.count("*") / cfg.block).cast("int").alias("blocks"))
    common = common.join(blocks, "token").withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    common = common.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    common = common.withColumn("i", F.least("at", "other")).withColumn("j", F.greatest("at", "other")).withColumn("key", F.col("token"))
    columns = ["common", "key", "i", "j", "token", "id", "class", "n", "sketch"]
    met = light.select(*columns).union(common.select(*columns)).groupBy("common", "key", "i", "j")
    pairs = stored(met.applyInPandas(_crossing(cfg), "a long, b long").distinct(), "crossing")
    discard(entries)
    return pairs


def _numbered(reps: DataFrame) -> DataFrame:
    """``reps`` (h1, h2, doc) with ``id``, a number for each set: its document's, or where that names another set already (rows that
    repeat an id) one beyond all documents'. So the numbers, and with them the work, are the same in every run of unique ids."""
    firsts = reps.groupBy("doc").agg(F.min(F.struct("h1", "h2")).alias("f")).select("f.h1", "f.h2", F.lit(True).alias("_own"))
    low, high = reps.agg(F.min("doc"), F.max("doc")).first()
    low, high = low or 0, high or 0
    above = 2**63 - 1 - high > low + 2**63  # on the side where there is more room
    other = F.lit(high + 1) + F.monotonically_increasing_id() if above else F.lit(low - 1) - F.monotonically_increasing_id()
    numbered = reps.join(firsts, ["h1", "h2"], "left")
    return stored(numbered.select("h1", "h2", "doc", F.when(F.col("_own"), F.col("doc")).otherwise(other).alias("id")), "numbered")


def jaccard_classes(docs: DataFrame, cfg: JoinConfig = JoinConfig()) -> DataFrame:
    """doc_id, n_shingles, component_id of every row, ``tag``, a hash of its text, and ``class``, a number that no
    two classes share (rows that repeat an id may give two classes one component_id). Sets have numbers of their own, so rows that
    repeat an id with another text are compared like any others."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    key, kind = common_shingles(rows, cfg)
    tagged = rows.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    every = stored(tagged.mapInArrow(_describe(cfg, key, kind), "doc_id long, tag long, n long, h1 long, h2 long, prefix binary, rare binary, "
                                     "sketch binary"), "sets")
    reps = every.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("doc")).where("doc IS NOT NULL")
    reps = _numbered(stored(reps, "reps"))
    sets = every.join(reps, (every["h1"] == reps["h1"]) & (every["h2"] == reps["h2"]) & (F.col("doc_id") == F.col("doc")))
    sets = stored(sets.select("id", "doc", "n", every["h1"], every["h2"], "prefix", "rare", "sketch").dropDuplicates(["id"]), "distinct")

    sizes = {r["n"]: r["count"] for r in sets.where(F.col("n") <= 2 * cfg.largest_small).groupBy("n").count().collect()}
    small = boundary(sizes, cfg)
    few = sets.where(F.col("n") <= small).select("id", "doc", "h1", "h2")
    texts = _only(rows, few).join(few, F.col("doc_id") == F.col("doc")).select("id", "h1", "h2", "text").distinct()
    links = small_links(texts, cfg, small)

    lists = inverted_lists(sets.where(F.col("n") >= -(-cfg.percent * (small + 1) // 100)), cfg)
    for turn in range(cfg.stars):
        left = _classed(lists, links)
        centre = left.groupBy("token").agg(F.min_by("id", F.xxhash64("id", F.lit(turn))).alias("b"))
        stars = left.join(centre, "token").where("id <> b").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
        found = _verify(stars, sets, rows, cfg)
        was, links = links, stored(links.union(found), "links")
        discard(left, found, was)
    left = _classed(lists, links)
    discard(lists)
    crossing = _cross_pairs(left, sets, cfg)
    discard(left)
    links = links.union(_verify(crossing, sets, rows, cfg))
    discard(crossing)
    label = components(links)
    numbered = reps.join(label, F.col("id") == F.col("node"), "left").select("h1", "h2", "doc", F.coalesce("component_id", "id").alias("class"))
    numbered = stored(numbered, "classes")
    least = numbered.groupBy("class").agg(F.min("doc").alias("component_id"))
    named = numbered.join(least, "class").select("h1", "h2", "component_id", "class")
    out = every.select("doc_id", "tag", "n", F.when(F.col("n") > 0, F.col("h1")).alias("h1"), "h2").join(named, ["h1", "h2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "tag", "class")
