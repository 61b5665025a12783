"""Mixing sources to target weights: token blocks, multinomial draws per output shard, index permutations, a join by index.

1. Sizes are words. Sources by code point (null last) weigh 5, 2, 1, repeating; their targets share the corpus's words, none
   above ``most`` times its source's (the excess is shared again by weight).
2. Each source's documents, laid end to end, are cut into blocks of ``block`` words. A source takes whole passes over its
   blocks and a part of one more, so many slots that their words come to its target.
3. Every output shard draws how many of its slots each source fills (multinomial, by target share). The draws of a source
   are numbered through the shards and end at the slots it has; slots that the draws left over go to shards by hash.
4. Slot ``j`` of a source is block ``permutation(j mod blocks)``: a keyed pseudorandom permutation of the indexes, so each
   pass takes each block once, and no document is taken more than ``most`` times.
5. Slots and documents meet in a join on (source, block).

All draws are keyed by the seed, the source and the shard, never by the run: reruns agree. Null and empty texts have size 0:
they stay in the result, take nothing, and a source of nothing else has target 0. Repeated rows count each for itself. An
empty table gives no rows. Other columns are not read. The sources themselves (a name, a size) are gathered at the driver,
as weights are a decision per source; ``max_sources`` bounds them, and more raise an error.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import WORD, stored, text_of, unused, with_offsets


@dataclass(frozen=True)
class MixConfig:
    """weights: in turn for the sources by name; block: words; shard: slots of an output shard; task_slots: about as many a task lays out."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most: int = 3
    block: int = 256
    shard: int = 1024
    seed: int = 7
    task_slots: int = 1 << 20
    max_sources: int = 1_000_000


def targets(sizes: list[int], cfg: MixConfig = MixConfig()) -> list[float]:
    """Each source's words in the mix; ``sizes`` in the order of the sources' names."""
    target, open_ = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    rest = float(sum(sizes))
    while open_:
        weight = sum(cfg.weights[i % len(cfg.weights)] for i in open_)
        share = {i: rest * cfg.weights[i % len(cfg.weights)] / weight for i in open_}
        full = [i for i in open_ if share[i] > cfg.most * sizes[i]]
        if not full:
            for i in open_:
                target[i] = share[i]
            break
        for i in full:
            target[i] = float(cfg.most * sizes[i])
            rest -= target[i]
        open_ = [i for i in open_ if i not in set(full)]
    return target


def permutation(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..n-1: a Feistel network over the next power of 4, walked until the value is in range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def rounds(x):
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            mixed = (right + np.uint64(key * 4 + r + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(32)) & mask
        return left << np.uint64(half) | right

    with np.errstate(over="ignore"):
        out = rounds(index.astype(np.uint64))
        while (far := out >= n).any():
            out[far] = rounds(out[far])
    return out.astype(np.int64)


def _sources(sized: DataFrame, cfg: MixConfig) -> pd.DataFrame:
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size")).limit(cfg.max_sources + 1).collect()
    if len(rows) > cfg.max_sources:
        raise ValueError(f"more than {cfg.max_sources} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["source_size"]) for r in rows]
    out = pd.DataFrame({"s": range(len(rows)), "source": [r["source"] for r in rows], "source_size": sizes,
                        "target": targets(sizes, cfg)})
    out["blocks"] = [-(-n // cfg.block) for n in sizes]
    passes = [min(cfg.most, int(t // n)) if n else 0 for t, n in zip(out["target"], sizes)]
    rest = [t - p * n for t, p, n in zip(out["target"], passes, sizes)]
    part = [0 if p == cfg.most else round(r / cfg.block) if r < n - n % cfg.block else b
            for r, n, p, b in zip(rest, sizes, passes, out["blocks"])]
    out["slots"] = [b * p + min(x, b) for b, p, x in zip(out["blocks"], passes, part)]
    return out


def _draws(spark, sources: pd.DataFrame, cfg: MixConfig) -> DataFrame:
    """(s, shard, n): the sources' slots in each output shard."""
    total = int(sources["slots"].sum())
    shards = max(1, math.ceil(total / cfg.shard))
    share = (sources["slots"] / max(total, 1)).to_numpy()

    def draw(batches):
        for pdf in batches:
            for shard in pdf["id"]:
                n = np.random.default_rng([cfg.seed, shard]).multinomial(min(cfg.shard, total - shard * cfg.shard), share)
                got = np.flatnonzero(n)
                yield pd.DataFrame({"s": got, "shard": shard, "n": n[got]})

    return spark.range(shards if total else 0).mapInPandas(draw, "s long, shard long, n long")


def draw_slots(spark, sources: pd.DataFrame, cfg: MixConfig) -> DataFrame:
    """(s, block, shard) of every slot of every source."""
    total = int(sources["slots"].sum())
    shards = max(1, math.ceil(total / cfg.shard))
    slots, blocks = dict(zip(sources["s"], sources["slots"])), dict(zip(sources["s"], sources["blocks"]))
    drawn = with_offsets(_draws(spark, sources, cfg), ["s"], ["shard"], "n").select("s", "shard", "pos", "n")
    # what a source's draws fell short of its slots, in chunks that tasks share
    got = {r["s"]: r["n"] for r in drawn.groupBy("s").agg(F.sum("n").alias("n")).collect()}
    short = [(int(s), -1, int(at), int(min(cfg.shard, n - at)))
             for s, n in slots.items() for at in range(got.get(s, 0), n, cfg.shard)]
    late = spark.createDataFrame(short, "s long, shard long, pos long, n long")

    def expand(batches):
        for pdf in batches:
            for s, shard, pos, n in pdf[["s", "shard", "pos", "n"]].itertuples(index=False):
                j = np.arange(pos, min(pos + n, slots[s]))
                if len(j):
                    where = np.full(len(j), shard) if shard >= 0 else permutation(j, slots[s], cfg.seed) % shards
                    yield pd.DataFrame({"s": s, "block": permutation(j % blocks[s], blocks[s], cfg.seed + zlib.crc32(str(s).encode()) % 2**20),
                                        "shard": where})

    tasks = max(1, math.ceil(total / cfg.task_slots))  # an explicit number: rows are tiny, but each makes up to ``shard`` slots
    return drawn.union(late).repartition(tasks, "s", "shard", "pos").mapInPandas(expand, "s long, block long, shard long")


def lay_out(docs: DataFrame, cfg: MixConfig) -> tuple[DataFrame, pd.DataFrame]:
    """The documents (every column but the text given in ``docs``) with s, size, pos and a row number; the sources."""
    sources = _sources(docs, cfg)
    spark = docs.sparkSession
    names = spark.createDataFrame([(int(i), s) for i, s in zip(sources["s"], sources["source"])], "s long, _source string")
    keyed = docs.join(names, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return with_offsets(keyed, ["s"], ["doc_id", "size"], "size"), sources


def _sized(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, "doc_id", F.col("source").cast("string").alias("source"),
                       F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"))


def mix(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, size, source_size, target, ``taken`` (words the mix takes of the document, repeats counted) and ``shards``: the
    numbers of the output shards that the draws send its blocks to."""
    spark = docs.sparkSession
    sized = stored(_sized(docs).withColumn("_row", F.monotonically_increasing_id()), "sized")
    placed, sources = lay_out(sized, cfg)
    slots = draw_slots(spark, sources, cfg)
    times = slots.groupBy("s", "block").agg(F.count("*").alias("times"), F.collect_set("shard").alias("into"))  # at most ``most`` shards
    taken = _pieces(placed, cfg).join(times, ["s", "block"]).groupBy("_row").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("into")))).alias("shards"))
    facts = spark.createDataFrame(
        [(r.source, int(r.source_size), float(r.target)) for r in sources.itertuples()], "_source string, source_size long, target double")
    out = sized.join(taken, "_row", "left").join(facts, F.col("source").eqNullSafe(F.col("_source")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                      F.coalesce("shards", F.array().cast("array<long>")).alias("shards"))


def _pieces(placed: DataFrame, cfg: MixConfig) -> DataFrame:
    """(_row, s, block, words) for each block that a document has words in."""
    first, last = F.floor(F.col("pos") / cfg.block), F.floor((F.col("pos") + F.col("size") - 1) / cfg.block)
    each = placed.where("size > 0").select("_row", "s", "pos", "size", F.explode(F.sequence(first, last)).alias("block"))
    words = F.least(F.col("pos") + F.col("size"), (F.col("block") + 1) * cfg.block) - F.greatest(F.col("pos"), F.col("block") * cfg.block)
    return each.select("_row", "s", "pos", "block", words.cast("long").alias("words"))


def mixed_documents(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mix as rows with the columns of ``docs``: one for each pass that takes words of a document. A pass that takes all
    of them gives the text as it is; the last, partial pass may take some blocks only, and gives the words in those."""
    spark = docs.sparkSession
    row, pieces_ = unused(docs, "_row"), unused(docs, "_pieces")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mixed")
    sized = stored(_sized(whole, F.col(row).alias("_row")), "sized")
    placed, sources = lay_out(sized, cfg)
    times = draw_slots(spark, sources, cfg).groupBy("s", "block").agg(F.count("*").alias("times"))
    pieces = _pieces(placed, cfg).join(times, ["s", "block"])
    first = F.greatest(F.col("block") * cfg.block - F.col("pos"), F.lit(0)).cast("long")
    chosen = pieces.groupBy(F.col("_row").alias(row)).agg(  # at most a text's words / block
        F.sort_array(F.collect_list(F.struct(first.alias("at"), "words", "times"))).alias(pieces_))
    word = re.compile(WORD)

    def cut(batches):
        for pdf in batches:
            rows, texts = [], []
            for i, (text, own) in enumerate(zip(pdf["text"], pdf[pieces_])):
                ends = [m.span() for m in word.finditer(text or "")]
                for turn in range(1, max(p["times"] for p in own) + 1):
                    taken = [p for p in own if p["times"] >= turn]
                    if sum(p["words"] for p in taken) == len(ends):
                        texts.append(text)
                    else:
                        runs = []
                        for p in taken:
                            if runs and runs[-1][1] == p["at"]:
                                runs[-1][1] += p["words"]
                            else:
                                runs.append([p["at"], p["at"] + p["words"]])
                        texts.append("\n".join(text[ends[a][0]: ends[b - 1][1]] for a, b in runs))
                    rows.append(i)
            yield pdf.iloc[rows].assign(text=texts).drop(columns=[pieces_])

    joined = whole.join(chosen, row).select(*docs.columns, pieces_)
    return joined.mapInPandas(cut, docs.schema)
