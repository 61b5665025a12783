"""The main text of web pages: markup says what it can, repetition across a host's pages decides the rest.

A page is cut into blocks by its tags (unclosed ones too). Blocks inside elements that are not main text go: by name (nav, footer,
form, script ...) or by a word of their class, id or role (menu, ad, cookie, comments ...). If the page marks its article (article,
main, a role, a usual class), the blocks inside are its text, and nothing else is taken or lost. Headings in an article's header stay.

Every page goes through its host's suffix array, whether it marks an article or not: the token streams of the host's different pages
are concatenated, suffixes sorted to a depth of ``min_run`` tokens, and runs of at least that length that occur in at least
``min_pages`` different pages count as covered. Where a page marks no article, its remaining blocks are open, and what is covered
decides: a block that is mostly covered loses it, and keeps unique runs of ``min_run`` tokens or more; other blocks stay whole. Where
a page marks its article, markup is exact and has the last word. Block borders are tokens, so that a menu of single words is a run.

A host of any size is dealt into shards of about ``shard_tokens`` tokens, each with a suffix array of its own; windows of the sorted
order are added up across shards by their hash, so that the result does not depend on the shards. Runs that a shard alone repeats often
enough are written for every host; those that only several shards together might are written where an open page of the host could
hold them, as nothing else reads them. Pages travel to their host packed. Pages with equal streams count once.

Null and empty html gives an empty text; a null url is a host of its own; repeated rows each give a row; without rows the result is
empty. Columns besides page_id, url and html are not read. Character references are decoded, white space (Unicode's) becomes one space.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from html import unescape
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import stored

# Element names, and words of classes, ids and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    select summary table tbody td template tfoot th thead tr ul""".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_TEXT = frozenset("""aside audio button canvas datalist dialog fieldset footer form head iframe map math menu nav noembed noframes
    noscript object script search select style svg template textarea title video""".split())
NOT_TEXT_WORDS = frozenset("""ad ads advert advertisement advertising adverts alert alertdialog banner breadcrumb breadcrumbs comment
    commentlist comments complementary consent contentinfo cookie cookies copyright dialog disqus footer gdpr login masthead menu menubar
    modal nav navbar navigation newsletter notice overlay pager pagination popup promo promotion promotions recommended related replies
    respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split())
ARTICLE_WORDS = frozenset("""article article-body article-content article-text articlebody entry entry-content main main-content post
    post-body post-content post-text story story-body""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
          "option": {"option"}}
LISTS = frozenset("ul ol dl table select".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")

#: A block's border in a token stream. No word holds white space.
BORDER = "\n"


@dataclass(frozen=True)
class ExtractConfig:
    min_run: int = 8
    min_pages: int = 3
    covered_share: float = 0.5
    shard_tokens: int = 2_000_000


# -- one page ---------------------------------------------------------------------------------

def _marks(name: str, attributes: str) -> tuple[int, int]:
    """(2 not main text, 1 a header, 0 neither; rank as an article: 3 article, 2 main, 1 by class) of an element."""
    drop = 2 if name in NOT_TEXT else 1 if name == "header" else 0
    rank = {"article": 3, "main": 2}.get(name, 0)
    if attributes and not drop:
        found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
        names = " ".join(found.get(a, "") for a in ("class", "id", "role"))
        words = {w.lower() for w in _WORD.findall(names)}
        hidden = re.search(r"(?:^|\s)hidden(?:\s|$)", attributes) or found.get("aria-hidden") == "true"
        if hidden or re.search(r"display\s*:\s*none", found.get("style", "")):
            drop = 2
        elif name not in ("html", "body", "main") and (name != "article" or "comment" in words):
            drop = 2 if words & NOT_TEXT_WORDS else 1 if "header" in words else 0
        if not drop and not rank:
            role = found.get("role", "").lower()
            whole = {w.lower() for w in names.split()}
            rank = (3 if role == "article" or found.get("itemprop", "").lower() == "articlebody" else 2 if role == "main"
                    else 1 if whole & ARTICLE_WORDS and name not in ("html", "body") else 0)
    return drop, rank


def page_blocks(html: str) -> list[tuple[int, str]]:
    """(rank, text) of the blocks of a page that are not known to be something else; rank 0 is outside any article."""
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, int]] = [("", 0, 0)]
    open_names: Counter = Counter()

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((stack[-1][2], text))
        pieces.clear()

    def close(index: int) -> None:
        for frame in stack[index:]:
            open_names[frame[0]] -= 1
        del stack[index:]

    def innermost(names: set[str], stop: frozenset[str] = frozenset()) -> int:
        if not any(open_names[n] for n in names):
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                return 0
        return 0

    def data(start: int, end: int) -> None:
        if start < end and not stack[-1][1]:
            text = html[start:end]
            pieces.append(unescape(text) if "&" in text else text)

    at = 0
    while True:
        tag = _TAG.search(html, at)
        if tag is None:
            break
        data(at, tag.start())
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        block = name in BLOCK
        if block:
            flush()
        if tag[1]:
            if index := innermost({name}):
                if not block and stack[-1][2] != stack[index - 1][2]:
                    flush()
                close(index)
            continue
        if name == "br":
            pieces.append(" ")
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
            continue
        if block and (index := innermost({"p"}, LISTS | {"div", "article", "section", "main", "td", "li"})):
            close(index)
        if name in CLOSES and (index := innermost(CLOSES[name], LISTS)):
            close(index)
        drop, rank = _marks(name, tag[3])
        _, dropped, ranked = stack[-1]
        if dropped == 1 and ranked and name in HEADING and not drop:
            dropped = 0
        if rank > ranked and not block:
            flush()
        stack.append((name, max(drop, dropped), max(rank, ranked)))
        open_names[name] += 1
    data(at, len(html))
    flush()
    return blocks


#: Streams that a parsing task knows again; beyond that it starts anew, and a copy costs a row more.
KNOWN_STREAMS = 200_000


def _parsed(batches):
    """Per page: its blocks, packed, as they are stored and shuffled; which of them its article holds (null if it marks none: it is open), and its stream. ``lead`` is the first
    page of a task with that stream, so that a page with many copies is one row of each task for its host."""
    known: set[tuple] = set()
    for batch in batches:
        out = []
        for host, html in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            blocks = page_blocks(html or "")
            best = max((rank for rank, _ in blocks), default=-1)
            texts = [text for _, text in blocks]
            joined = BORDER.join(texts).encode()
            digest = sha256(joined)
            if len(known) >= KNOWN_STREAMS:
                known.clear()
            seen = len(known)
            known.add((host, digest.digest()))
            out.append((zlib.compress(joined), [rank == best for rank, _ in blocks] if best else None, digest.hexdigest(),
                        sum(text.count(" ") + 2 for text in texts), bool(texts) and len(known) > seen))
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate(
            (pa.binary(), pa.list_(pa.bool_()), pa.string(), pa.int64(), pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["page_id", "url", "host", "packed", "inside", "stream", "n", "lead"])


def _unpacked(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode().split(BORDER)


def _articles(batches):
    """The text of pages that mark their article."""
    for batch in batches:
        texts = [BORDER.join(b for b, kept in zip(_unpacked(p), inside) if kept) for p, inside in zip(*(c.to_pylist() for c in batch.columns[2:]))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])


# -- a host's pages ---------------------------------------------------------------------------

_PLACES = np.uint64(0x9E3779B97F4A7C15)


def window_classes(streams: list[list[str]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, page, hash) of every window of ``depth`` tokens, in the order of the suffix array of all streams.

    Suffixes are sorted by doubling the sorted prefix, as far as ``depth``; neighbours that agree so far share a rank."""
    lengths = np.array([len(s) for s in streams])
    flat = np.array([t for s in streams for t in s], dtype=object)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    page = np.repeat(np.arange(len(streams)), lengths)
    position = np.arange(len(flat))
    whole = position + depth <= starts[page + 1]  # no window leaves its page
    at = position[whole]
    if not len(at):
        return at, at, at.astype(np.uint64)
    codes, words = pd.factorize(flat, sort=True)
    rank, reach = codes.astype(np.int64), 1
    while reach < depth:
        step = min(reach, depth - reach)
        last = len(rank) - step
        pair = rank[:last] * (rank.max() + 1) + rank[step:]
        rank, reach = np.unique(pair, return_inverse=True)[1], reach + step
    order = at[np.argsort(rank[at], kind="stable")]
    word_hash = pd.util.hash_array(np.asarray(words, dtype=object), categorize=False)[codes]
    hashed = np.zeros(len(order), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(depth):
            hashed = (hashed ^ (word_hash[order + k] + np.uint64(k))) * _PLACES
            hashed ^= hashed >> np.uint64(29)
    return order, page[order], hashed


def _stream(blocks: list[str]) -> list[str]:
    return [token for block in blocks for token in (*block.split(), BORDER)]


def unique_text(blocks: list[str], covered: np.ndarray, cfg: ExtractConfig) -> str:
    """What is left of a page's blocks, ``covered`` telling for each token of its stream whether the host repeats it."""
    kept, at = [], 0
    for block in blocks:
        words = block.split()
        over = covered[at:at + len(words)]
        at += len(words) + 1
        if over.mean() < cfg.covered_share:
            kept.append(block)
            continue
        for hit, run in groupby(zip(over, words), key=lambda p: bool(p[0])):
            run = [w for _, w in run]
            if not hit and len(run) >= cfg.min_run:
                kept.append(" ".join(run))
    return "\n".join(kept)


_WINDOW = "host string, shard long, window long, pages long"


def _shards(rows: Iterator[tuple]) -> Iterator[tuple]:
    return groupby(rows, key=lambda r: (r[0], r[1]))


def _tuples(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _open_texts(parsed: DataFrame, cfg: ExtractConfig) -> DataFrame:
    """(host, stream, text): what is unique in each different open page, by the runs that all pages of its host repeat."""
    sizes = parsed.where("lead").groupBy("host", "stream").agg(F.max("n").alias("n"))
    hosts = sizes.groupBy("host").agg(F.sum("n").alias("_total")).where(F.col("_total") > cfg.shard_tokens).withColumnRenamed("host", "_host")
    shards = F.coalesce(F.ceil(F.col("_total") / cfg.shard_tokens), F.lit(1)).cast("long")

    def dealt(pages: DataFrame) -> DataFrame:
        # at most one host for each shard_tokens tokens
        return pages.join(F.broadcast(hosts), F.col("host") == F.col("_host"), "left").select(
            "host", F.pmod(F.xxhash64("stream"), shards).alias("shard"), "stream", "packed", shards.alias("shards"))

    def windows(batches):
        for (host, shard), rows in _shards(_tuples(batches)):
            pages, alone = {}, True
            for _, _, stream, packed, shards, has_open in rows:
                pages[stream] = packed  # copies come from several tasks
                alone = shards == 1 or not has_open
            _, page, hashed = window_classes([_stream(_unpacked(p)) for p in pages.values()], cfg.min_run)
            order = np.lexsort((page, hashed))
            page, hashed = page[order], hashed[order]
            first = np.ones(len(page), bool)
            first[1:] = (hashed[1:] != hashed[:-1]) | (page[1:] != page[:-1])
            values, counts = np.unique(hashed[first], return_counts=True)
            if alone:  # nothing asks what other shards add to these
                values, counts = values[counts >= cfg.min_pages], counts[counts >= cfg.min_pages]
            for low in range(0, len(values), 50_000):
                part = values[low:low + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([host] * len(part), pa.string()), pa.array([shard] * len(part), pa.int64()),
                                                  pa.array(part.view(np.int64)), pa.array(counts[low:low + 50_000], pa.int64())],
                                                 ["host", "shard", "window", "pages"])

    asking = parsed.where("inside IS NULL").select(F.col("host").alias("_asking")).distinct().join(hosts, F.col("_asking") == F.col("_host"), "left_semi")
    every = dealt(parsed.where("lead")).join(F.broadcast(asking), F.col("host") == F.col("_asking"), "left")
    every = every.withColumn("has_open", F.col("_asking").isNotNull()).drop("_asking")
    every = every.repartition("host", "shard").sortWithinPartitions("host", "shard")
    found = stored(every.mapInArrow(windows, _WINDOW), "windows")
    repeated = found.groupBy("host", "window").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= cfg.min_pages)
    heads = found.drop("pages").join(repeated.drop("pages"), ["host", "window"]).select(
        "host", "shard", F.lit(0).alias("kind"), "window", F.lit(None).cast("string").alias("stream"), F.lit(None).cast("binary").alias("packed"))
    opened = parsed.where("inside IS NULL").groupBy("host", "stream").agg(F.first("packed").alias("packed"))
    bodies = dealt(opened).select("host", "shard", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("window"), "stream", "packed")

    def extract(batches):
        for (host, shard), rows in _shards(_tuples(batches)):
            known, held = [], []
            for row in rows:
                if row[2] == 0:
                    known.append(row[3])
                else:
                    held.append(row)
            if not held:
                continue
            repeats = np.array(known, np.int64).view(np.uint64)
            opens = [_unpacked(r[5]) for r in held]
            streams = [_stream(blocks) for blocks in opens]
            order, _, hashed = window_classes(streams, cfg.min_run)
            starts = order[np.isin(hashed, repeats)]
            edge = np.zeros(sum(map(len, streams)) + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + cfg.min_run, -1)
            covered, at, texts = np.cumsum(edge) > 0, 0, []
            for blocks, stream in zip(opens, streams):
                texts.append(unique_text(blocks, covered[at:at + len(stream)], cfg))
                at += len(stream)
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(held), pa.string()), pa.array([r[4] for r in held], pa.string()),
                                              pa.array(texts, pa.string())], ["host", "stream", "text"])

    both = heads.union(bodies).repartition("host", "shard").sortWithinPartitions("host", "shard", "kind")
    return both.mapInArrow(extract, "host string, stream string, text string")


def main_text(pages: DataFrame, cfg: ExtractConfig = ExtractConfig()) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html)."""
    fields = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema.fields}
    schema = (f"page_id {fields['page_id']}, url {fields['url']}, host string, packed binary, inside array<boolean>, stream string, "
              "n long, lead boolean")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1)), F.lit(""))
    whole = pages.select("page_id", "url", host.alias("host"), F.col("html").cast("string"))
    parsed = stored(whole.mapInArrow(_parsed, schema), "parsed-pages")
    texts = _open_texts(parsed, cfg)
    marked = parsed.where("inside IS NOT NULL").select("page_id", "url", "packed", "inside")
    marked = marked.mapInArrow(_articles, schema.split(", host")[0] + ", text string")
    opened = parsed.where("inside IS NULL").select("page_id", "url", "host", "stream")
    if not opened.isEmpty():
        marked = marked.union(opened.join(texts, ["host", "stream"]).select("page_id", "url", "text"))
    return marked.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
