"""Sharding by balanced label propagation: linked documents gather in one shard, and shards stay even.

Documents with equal texts are linked. The law is ``rows``: the shards' counts differ by at most one.

1. Groups above an eighth of a shard (at most 8 x shards of them) can't move as one: they fill the emptiest shards first. Every
   other linked document starts by hash in the room they left. Documents of one group are alike to their neighbours, so the
   labels of a group are kept as counts by shard (at most ``shards`` of them), never as links or lists of documents.
2. Each round, a group in several shards wants to move to the one with most of it among those with room for the rest of it,
   or else to any shard with room for all of it. Moves into a shard are admitted up to its quota: what it has free, a slack, and
   half of what wants to leave it. Groups are admitted by hash, in ``buckets`` parts counted for each shard, so the driver sees
   shards x shards x buckets numbers at most. What wants to leave counts as room until a round admits nothing; then only what
   is free does. Rounds end when no group wants to move or none fits: each makes at least one group whole, and whole ones stay.
3. Documents take their group's labels in order. What a shard holds above its count is released, group by group, and goes
   with the unlinked documents to the shards' free places by running number, which makes the counts exact.

Each cut group costs links between shards; unlinked documents cost nothing wherever they go. Null texts count as empty (size
8) and are linked with the empty ones. Repeated rows are linked documents. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import discard, stored, text_of, with_offsets


@dataclass(frozen=True)
class ShardConfig:
    shards: int = 24
    buckets: int = 256
    slack: float = 0.05  # share above its count that a shard may hold until the release
    overhead: int = 8  # bytes a document takes besides its text


def _units(docs: DataFrame, cfg: ShardConfig) -> DataFrame:
    text = text_of()
    return docs.select("doc_id", (F.octet_length(text) + cfg.overhead).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("group"),
                       F.monotonically_increasing_id().alias("_row"))


def _cells(units: DataFrame, large: int, free: list[int]) -> DataFrame:
    """(group, total, cells: array<struct<shard, n>>) of the groups from two to ``large``, from labels by hash over the free room."""
    at = F.pmod(F.xxhash64("doc_id", "_row"), F.lit(max(sum(free), 1)))
    first = _by_interval(at, _intervals(free), lambda lo, h: F.lit(h)).cast("int")
    counts = units.groupBy("group", first.alias("shard")).agg(F.count("*").alias("n"))
    cells = F.collect_list(F.struct("shard", "n"))  # at most one for each shard
    groups = counts.groupBy("group").agg(F.sum("n").alias("total"), F.sort_array(cells).alias("cells"))
    return groups.where((F.col("total") > 1) & (F.col("total") <= large))


def _loads(state: DataFrame, cfg: ShardConfig) -> tuple[list[int], list[int]]:
    """What each shard holds, and how much of it belongs to groups in several shards."""
    parts = state.select((F.size("cells") > 1).alias("cut"), F.explode("cells").alias("c"))
    load, cut = [0] * cfg.shards, [0] * cfg.shards
    for r in parts.groupBy("cut", "c.shard").agg(F.sum("c.n").alias("n")).collect():
        load[r["shard"]] += r["n"]
        cut[r["shard"]] += r["n"] * r["cut"]
    return load, cut


def _target(turn: int, reach: list[int]) -> Column:
    """The shard that a group wants to move to; -1 if it is whole or fits nowhere."""
    rooms = F.array(*map(F.lit, reach))
    near = F.filter("cells", lambda c: F.col("total") - c["n"] <= F.element_at(rooms, c["shard"] + 1))
    most = F.array_max(F.transform(near, lambda c: F.struct(c["n"], F.xxhash64("group", c["shard"]).alias("tie"), c["shard"])))["shard"]
    shards = F.array(*(F.struct(F.lit(h).alias("shard"), F.lit(n).alias("room")) for h, n in enumerate(reach)))
    far = F.filter(shards, lambda s: s["room"] >= F.col("total"))
    any_far = F.get(far, F.pmod(F.xxhash64("group", F.lit(turn)), F.greatest(F.size(far), F.lit(1))).cast("int"))["shard"]
    return F.when(F.size("cells") > 1, F.coalesce(most, any_far, F.lit(-1))).otherwise(F.lit(-1))


def _fill(groups: list, load: list[int], room: list[int]) -> dict[str, list[tuple[int, int]]]:
    """Groups too large to move as one: each takes the emptiest shards, whole ones first."""
    out = {}
    for r in sorted(groups, key=lambda r: (-r["total"], r["group"])):
        left, cells = r["total"], []
        while left:
            best = max(range(len(load)), key=lambda h: (room[h] - load[h], -h))
            n = min(left, max(room[best] - load[best], 1))
            cells.append((best, n))
            load[best] += n
            left -= n
        merged: dict[int, int] = {}
        for h, n in cells:
            merged[h] = merged.get(h, 0) + n
        out[r["group"]] = sorted(merged.items())
    return out


def propagate(units: DataFrame, total: int, cfg: ShardConfig) -> DataFrame:
    """(group, cells) after the rounds."""
    spark = units.sparkSession
    room = [total // cfg.shards + (h < total % cfg.shards) for h in range(cfg.shards)]
    large = max(2, total // cfg.shards // 8)
    above = units.groupBy("group").agg(F.count("*").alias("total")).where(F.col("total") > large)
    fixed = _fill(above.collect(), load := [0] * cfg.shards, room)
    kept = [(g, [{"shard": h, "n": n} for h, n in cells]) for g, cells in fixed.items()]
    settled = spark.createDataFrame(kept, "group string, cells array<struct<shard:int,n:bigint>>")
    state = stored(_cells(units, large, [max(r - n, 0) for r, n in zip(room, load)]), "labels")
    turn, strict = 0, False
    while True:
        mine, cut = _loads(state, cfg)
        free = [int(r * (1 + cfg.slack)) - m - n for r, m, n in zip(room, mine, load)]
        reach = [f + (0 if strict else c // 2) for f, c in zip(free, cut)]
        bucket = F.pmod(F.xxhash64("group", F.lit(turn), F.lit("bucket")), F.lit(cfg.buckets)).cast("int")
        wanting = state.withColumn("to", _target(turn, reach)).withColumn("bucket", bucket)
        moves = wanting.select("to", "bucket", F.explode("cells").alias("c")).where("to >= 0 AND c.shard <> to")
        asked = [[0] * cfg.buckets for _ in room]
        leaving = [0] * cfg.shards
        for r in moves.groupBy("to", "bucket", "c.shard").agg(F.sum("c.n").alias("n")).collect():  # shards^2 x buckets at most
            asked[r["to"]][r["bucket"]] += r["n"]
            leaving[r["shard"]] += r["n"]
        admitted = []
        for h, want in enumerate(asked):
            quota, fits = free[h] + (0 if strict else leaving[h] // 2), ""
            for n in want:
                fits += "1" if 0 < n <= quota else "0"
                quota -= n if 0 < n <= quota else 0
            admitted.append(fits)
        turn += 1
        if not any("1" in fits for fits in admitted):
            if strict or not any(cut):
                break
            strict = True
            continue
        strict = False
        fits = F.substring(F.get(F.array(*map(F.lit, admitted)), F.col("to")), F.col("bucket") + 1, F.lit(1)) == "1"
        whole = F.array(F.struct(F.col("to").alias("shard"), F.col("total").alias("n")))
        moved = wanting.select("group", "total", F.when((F.col("to") >= 0) & fits, whole).otherwise(F.col("cells")).alias("cells"))
        last, state = state, stored(moved, "labels")
        discard(last)
    return state.select("group", "cells").union(settled)


def _label() -> Column:
    """The shard of a document by its number within its group."""
    start = F.struct(F.lit(0).cast("long").alias("until"), F.lit(-1).alias("shard"))
    step = lambda a, c: F.struct(
        (a["until"] + c["n"]).alias("until"),
        F.when(F.col("pos") < a["until"], a["shard"]).otherwise(c["shard"]).alias("shard"))
    return F.aggregate("cells", start, step)["shard"]


def _intervals(sizes: list[int]) -> list[tuple[int, int, int]]:
    """(from, until, shard) of each shard's stretch when ``sizes`` are laid end to end."""
    ends = list(accumulate(sizes))
    return [(end - n, end, h) for h, (n, end) in enumerate(zip(sizes, ends))]


def _by_interval(at: Column, bounds: list[tuple[int, int, int]], value) -> Column:
    out = F.lit(None)
    for lo, hi, h in bounds:
        out = F.when((at >= lo) & (at < hi), value(lo, h)).otherwise(out)
    return out


def balanced_shards(docs: DataFrame, cfg: ShardConfig = ShardConfig()) -> DataFrame:
    """doc_id, size, text_crc32, group, shard, slot (gapless from 0 in a shard) of every document."""
    units = stored(_units(docs, cfg), "units")
    total = units.count()
    room = [total // cfg.shards + (h < total % cfg.shards) for h in range(cfg.shards)]
    state = propagate(units, total, cfg)
    tagged = stored(units.join(state, "group", "left"), "tagged")
    numbered = with_offsets(tagged.where("cells IS NOT NULL"), ["group"], ["doc_id", "_row"])
    labelled = numbered.withColumn("shard", _label()).drop("cells", "pos")
    linked = stored(with_offsets(labelled, ["shard"], ["group", "doc_id", "_row"]), "linked")
    limit = F.element_at(F.array(*map(F.lit, room)), F.col("shard") + 1)
    have = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    stay = linked.where(F.col("pos") < limit).withColumn("slot", F.col("pos"))
    columns = ["doc_id", "size", "text_crc32", "group", "_row"]
    released = linked.where(F.col("pos") >= limit).select(*columns, F.lit(0).alias("late"))
    pool = released.union(tagged.where("cells IS NULL").select(*columns, F.lit(1).alias("late")))
    pool = with_offsets(pool, [], ["late", "group", "doc_id", "_row"])
    bounds = _intervals([room[h] - min(room[h], have.get(h, 0)) for h in range(cfg.shards)])
    filled = pool.withColumn("shard", _by_interval(F.col("pos"), bounds, lambda lo, h: F.lit(h)))
    filled = filled.withColumn("slot", _by_interval(
        F.col("pos"), bounds, lambda lo, h: F.col("pos") - lo + min(room[h], have.get(h, 0))))
    out = ["doc_id", "size", "text_crc32", "group", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")]
    return stay.select(*out).union(filled.select(*out))
