"""Conversation structure: the cheapest edits that turn a damaged conversation into (system)? (user assistant)+ or nothing.

Turns are kept (0), given the role user or assistant (3), deleted (4) or inserted with empty text (3); blank and duplicate turns
must go, and a truncated turn that stays adds 3. Among the cheapest edits the ones whose initials come first in ASCII are taken.

The costs form a dynamic program over the turns: four states (nothing yet, after system, after user, after assistant), each with
the least cost to the end. Costs are kept at checkpoints only. Between tasks: a conversation is cut into blocks of ``block_rows``
turns, each block gives the 4 x 4 costs from its start to its end, and one scan back over these, four numbers a block, gives the
costs at each border. Within a block: a pass back keeps the costs at every square root of its length, and the walk forward works
each stretch out again from the checkpoint at its end. The walk goes from every state a block can start in; a scan forward picks.
So a conversation however long spreads over tasks, and a task holds one block. Only what must follow the whole conversation
streams through one task in order: the repaired turns (their digest is one hash over all of them) and the audit.

Rows: (conv_id, turn, role, text). Null conv_ids are one conversation; null turns come first; null roles and texts are one space;
equal turns are ordered by a digest of role and text; repeated rows are duplicates; an empty role, as any role that starts with
none of s, u, a, can't be kept. Tables without rows give none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import stored, with_offsets

#: Costs, states after each kept initial, and the state after a made turn (user, or assistant after user).
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SYSTEM, USER, ASSISTANT, OTHER = range(4)
AFTER = ({SYSTEM: 1, USER: 2}, {USER: 2}, {ASSISTANT: 3}, {USER: 2})
MADE = (2, 2, 3, 2)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
FAR = 1 << 60
EMPTY_SHA256 = sha256(b"").hexdigest()

SPACE = " \t\n\x0b\f\r"
#: A turn's code: initial, then one bit for each of blank, unfinished, duplicate.
BLANK, UNFINISHED, DUPLICATE = 4, 8, 16


@dataclass(frozen=True)
class RepairConfig:
    block_rows: int = 4096


def conversation_key(conv_id: str = "conv_id") -> Column:
    """The conversation as a text, in which null ids are one of their own."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit("null"))


def turns_of(rows: DataFrame) -> DataFrame:
    """(key, turn, role, text, digest) without nulls but in ``turn``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return rows.select(conversation_key().alias("key"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                       text.alias("text"), digest.alias("digest"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the damage that the hash of id and turn asks for: dropped, emptied, cut off, repeated or given to the user."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(name), F.lit(20))
    told = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).where("_kind <> 0")
    kind = F.col("_kind")
    changed = told.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"))
    return changed.drop("_copy")


# -- the dynamic program ----------------------------------------------------------------------

def _relaxed(v: list[int]) -> list[int]:
    """Costs with turns inserted before going on."""
    user = min(v[2], INSERT + v[3])
    return [min(v[0], INSERT + user), min(v[1], INSERT + user), user, min(v[3], INSERT + v[2])]


END = _relaxed([0, FAR, FAR, 0])


def _choices(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use the turn up, first in ASCII first."""
    yield "D", DELETE, state
    if code & (BLANK | DUPLICATE):
        return
    extra = TRUNCATED if code & UNFINISHED else 0
    kept = AFTER[state].get(code & 3)
    if kept is not None:
        yield "K", extra, kept
    yield "R", RENAME + extra, MADE[state]


CHOICES = [[tuple(_choices(code, state)) for state in range(4)] for code in range(32)]


def _before(code: int, after: list[int]) -> list[int]:
    return _relaxed([min([cost + after[to] for _, cost, to in edits]) for edits in CHOICES[code]])


def _walk(codes: list[int], end: list[int], starts: list[int], closing: bool) -> Iterator[tuple[int, int, str, int]]:
    """(start, finish, audit, cost) of the tight edits through a block from each of ``starts``."""
    n = len(codes)
    step = isqrt(max(n - 1, 0)) + 1
    marks, now = {n: end}, end
    for i in range(n - 1, -1, -1):
        now = _before(codes[i], now)
        if i % step == 0:
            marks[i] = now
    at = {start: start for start in starts}
    audits: dict[int, list[str]] = {start: [] for start in starts}
    for low in range(0, n, step):
        high = min(low + step, n)
        costs = [marks[high]]
        for i in range(high - 1, low - 1, -1):
            costs.append(_before(codes[i], costs[-1]))
        costs.reverse()
        for start in starts:
            state, audit = at[start], audits[start]
            for i in range(low, high):
                here, after, moved = costs[i - low], costs[i - low + 1], False
                while not moved:
                    left = here[state]
                    choices = CHOICES[codes[i]][state]
                    if left == DELETE + after[state]:
                        letter, moved = "D", True
                    elif left == INSERT + here[MADE[state]]:
                        letter, state = "I", MADE[state]
                    else:
                        letter, state = next((a, to) for a, cost, to in choices[1:] if left == cost + after[to])
                        moved = True
                    audit.append(letter)
            at[start] = state
    for start in starts:
        while closing and END[at[start]]:
            audits[start].append("I")
            at[start] = MADE[at[start]]
        yield start, at[start], "".join(audits[start]), now[start]


# -- the passes -------------------------------------------------------------------------------

_COUNTS = "illegal long, blank long, duplicate long, truncated long"
_SUMMARY = "key string, block long, costs array<long>, first int, last int, " + _COUNTS
_BORDER = "key string, block long, costs array<long>, closing boolean, " + _COUNTS
_WALK = "key string, block long, start int, finish int, audit string, cost long, " + _COUNTS
_PLAN = "key string, audit string, cost long, " + _COUNTS


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _rows(batches, schema: str | None = None) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def _batches(rows: Iterator[tuple], schema: str, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    names, types = _columns(schema), [_ARROW[part.split()[1]] for part in schema.split(", ")]

    def batch(held):
        columns = list(zip(*held)) if held else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch(held)
            held = []
    yield batch(held)


def _summaries(batches):
    def out():
        for (key, block), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
            codes = [row[3] for row in rows]
            costs = []
            for state in range(4):
                now = [FAR] * 4
                now[state] = 0
                for code in reversed(codes):
                    now = _before(code, now)
                costs += now
            blank = sum(1 for c in codes if c & BLANK)
            double = sum(1 for c in codes if c & DUPLICATE and not c & BLANK)
            cut = sum(1 for c in codes if c & (UNFINISHED | DUPLICATE | BLANK) == UNFINISHED)
            illegal = sum(1 for a, b in zip(codes, codes[1:]) if (a & 3, b & 3) not in LEGAL)
            yield key, block, costs, codes[0] & 3, codes[-1] & 3, illegal, blank, double, cut
    return _batches(out(), _SUMMARY)


def _borders(batches):
    """From the last block of each conversation to its first: the costs at each block's end."""
    def out():
        for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
            end, following = END, None
            for _, block, costs, first, last, illegal, *counts in rows:
                wrong = following is not None and (last, following) not in LEGAL
                yield key, block, end, following is None, illegal + wrong, *counts
                # an infinite entry stays infinite whatever is added to it
                end = [min(min(costs[4 * j + i] + end[j] for j in range(4)), FAR) for i in range(4)]
                following = first
    return _batches(out(), _BORDER)


def _walks(batches):
    def out():
        for (key, block), rows in groupby(_rows(batches), key=lambda r: (r[0], r[1])):
            border = next(rows)
            end, closing, counts = border[4], border[5], border[6:]
            codes = [row[3] for row in rows]
            for start, finish, audit, cost in _walk(codes, end, [0] if block == 0 else [0, 1, 2, 3], closing):
                yield key, block, start, finish, audit, cost, *counts
    return _batches(out(), _WALK, 200)


def _chosen(batches):
    def out():
        for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
            state, audits, total, sums = 0, [], None, [0, 0, 0, 0]
            for _, walks in groupby(rows, key=lambda r: r[1]):
                _, _, _, state, audit, cost, *counts = next(w for w in walks if w[2] == state)
                audits.append(audit)
                total = cost if total is None else total
                sums = [a + b for a, b in zip(sums, counts)]
            yield key, "".join(audits), total, *sums
    return _batches(out(), _PLAN, 200)


def _dealt(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def repair_plans(turns: DataFrame, cfg: RepairConfig = RepairConfig()) -> DataFrame:
    """key, audit, cost, illegal, blank, duplicate, truncated of each conversation of ``turns`` (as ``turns_of`` gives them)."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
            + F.when(trimmed == "", BLANK).otherwise(0)
            + F.when((trimmed != "") & ~F.substring(trimmed, -1, 1).isin(".", "!", "?"), UNFINISHED).otherwise(0))
    light = turns.select("key", "turn", "digest", code.alias("code"), F.monotonically_increasing_id().alias("tie"))
    placed = stored(with_offsets(light, ["key"], ["turn", "digest", "tie"]).select("key", "digest", "code", "pos"), "placed")
    # where a role and text is first: one row for each, so no key is hot in the join back
    firsts = placed.groupBy("key", "digest").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(0).alias("_again"))
    coded = placed.join(firsts, ["key", "pos"], "left").select(
        "key", F.floor(F.col("pos") / cfg.block_rows).alias("block"), "pos",
        (F.col("code") + F.coalesce("_again", F.lit(DUPLICATE))).cast("int").alias("code"))
    coded = stored(coded, "coded")
    summaries = _dealt(coded, ["key", "block"], ["pos"]).mapInArrow(_summaries, _SUMMARY)
    borders = summaries.repartition("key").sortWithinPartitions("key", F.desc("block")).mapInArrow(_borders, _BORDER)
    nothing = [F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in _BORDER.split(", ")[2:]]
    heads = borders.select("key", "block", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("code"), *_columns(_BORDER)[2:])
    walks = _dealt(heads.union(coded.select("key", "block", "pos", "code", *nothing)), ["key", "block"], ["pos"]).mapInArrow(_walks, _WALK)
    return _dealt(walks, ["key"], ["block", "start"]).mapInArrow(_chosen, _PLAN)


_TURN = "key string, place long, role string, text string"


def _applied(batches):
    """The repaired turns in order. An audit comes before its turns."""
    def out():
        for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
            audit, at, state, place = next(rows)[5], 0, 0, 0
            for row in rows:
                while audit[at] == "I":
                    state, at = MADE[state], at + 1
                    yield key, place, "user" if state == 2 else "assistant", ""
                    place += 1
                letter, at = audit[at], at + 1
                if letter == "D":
                    continue
                role = row[4]
                if letter == "K":
                    state = AFTER[state]["sua".index(role[0])]
                else:
                    state = MADE[state]
                    role = "user" if state == 2 else "assistant"
                yield key, place, role, row[5]
                place += 1
            for _ in audit[at:]:
                state = MADE[state]
                yield key, place, "user" if state == 2 else "assistant", ""
                place += 1
    return _batches(out(), _TURN, 500)


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """key, place, role, text: the conversations with their edits applied. Each partition holds whole conversations in order."""
    heads = plans.select("key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
                         F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    rows = turns.select("key", F.lit(1).alias("kind"), "turn", "digest", "role", "text")
    return _dealt(heads.union(rows), ["key"], ["kind", "turn", "digest"]).mapInArrow(_applied, _TURN)


def _hashed(batches):
    def out():
        for key, rows in groupby(_rows(batches), key=lambda r: r[0]):
            digest, between = sha256(), b""
            for _, _, role, text in rows:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield key, digest.hexdigest()
    return _batches(out(), "key string, repaired_sha256 string")


def digests(repaired: DataFrame) -> DataFrame:
    """key, repaired_sha256 of ``repaired_turns``, taken straight from it: the hash follows its order."""
    return repaired.mapInArrow(_hashed, "key string, repaired_sha256 string")


def repair_report(conversations: DataFrame, rows: DataFrame, cfg: RepairConfig = RepairConfig()) -> DataFrame:
    """One row for every conv_id of ``conversations``: what was wrong with its ``rows`` and how they were repaired."""
    turns = turns_of(rows)
    plans = stored(repair_plans(turns, cfg), "plans")
    hashes = digests(repaired_turns(turns, plans))
    turn = F.col("turn")
    gap = F.try_subtract(F.max(turn), F.min(turn)) + 1 - F.count_distinct(turn)
    gaps = turns.groupBy("key").agg(gap.alias("gaps"))
    ids = conversations.select(conversation_key().alias("key"), "conv_id").distinct()
    told = ids.join(gaps, "key", "left").join(plans, "key", "left").join(hashes, "key", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return told.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
