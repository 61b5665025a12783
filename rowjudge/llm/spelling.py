"""Spelling variants: words one edit apart, and the commoner form that each rare one most likely stands for.

Words are counted in the texts, then every pair that differs by exactly one inserted, deleted or replaced code point is found by
scanning sorted lists. A pair that is one edit apart agrees outside the edited place, so each word enters the lists of a few
keys: for its own length and the one below, cut into ``spans`` parts, all of the word but one part. Within a list only that part
is compared. A list longer than ``max_list`` is cut again by halving the part that may differ, until the part is one code point
and the list no longer than the alphabet allows: nothing is capped, and no list goes whole to one task however common its key.

In a list the scan goes through the words in order for each of them. It keeps the banded rows of the edit matrix by depth: the
next word takes over the rows of the prefix it shares with the last one, and once all of a row exceeds one edit, the scan skips
every word that shares that prefix.

Null and empty texts have no words; a null doc_id counts as empty text in the hash; repeated rows count each time; without rows
the result is empty. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import discard, stored, text_of

#: What a word is, and which occurrences lose a code point.
RUN = "[a-zÀ-ÿ]+"
DAMAGE_EVERY = 97


@dataclass(frozen=True)
class SpellingConfig:
    min_length: int = 5
    min_count: int = 3
    spans: int = 3
    max_list: int = 1024
    flush: int = 200_000


# -- counting ---------------------------------------------------------------------------------

def _text_words(doc_id: str, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text, lower-cased in A-Z only, with the damage that the hash of id and word asks for."""
    lowered = text.encode("utf-8", "replace").lower().decode("utf-8")
    for word, n in Counter(re.findall(RUN, lowered)).items():
        h = zlib.crc32(f"{doc_id}:{word}".encode())
        if h % DAMAGE_EVERY == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, n


def word_counts(docs: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n) over all texts: words of at least ``min_length`` code points with at least ``min_count`` occurrences. Each task
    adds up what it meets before anything is shuffled."""
    def count(batches):
        sums: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in _text_words(doc_id, text):
                    if len(word) >= cfg.min_length:
                        sums[word] += n
            if len(sums) >= cfg.flush:
                yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["word", "n"])
                sums = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(sums.values(), pa.int64())], ["word", "n"])

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of())
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= cfg.min_count)


# -- lists ------------------------------------------------------------------------------------

_ENTRY = "key long, word string, n long, start int, tail int, span int, last boolean"
_ENTRY_COLUMNS = [column.split()[0] for column in _ENTRY.split(", ")]


def _entries(words: DataFrame, cfg: SpellingConfig) -> DataFrame:
    """Each word under the keys of its own length and of the one below: the shorter word of a pair decides where parts end.
    ``start`` and ``tail`` are what the list has in common at the front and at the back."""
    length = F.length("word")
    roles: list[Column] = []
    for shorter in (0, 1):
        base = length - shorter
        for part in range(cfg.spans):
            start, end = F.floor(base * part / cfg.spans).cast("int"), F.floor(base * (part + 1) / cfg.spans).cast("int")
            tail = base - end
            same_back = F.expr("''") if part == cfg.spans - 1 else F.when(tail > 0, F.right("word", tail)).otherwise("")
            key = F.xxhash64(base, F.lit(part), F.substring("word", F.lit(1), start), same_back)
            roles.append(F.struct(key.alias("key"), F.col("word"), F.col("n"), start.alias("start"), tail.alias("tail"),
                                  (end - start).alias("span"), F.lit(part == cfg.spans - 1).alias("last")))
    return words.select(F.explode(F.array(*roles)).alias("e")).select("e.*").where((F.col("span") > 0) & (F.col("start") + F.col("span") + F.col("tail") >= cfg.min_length))


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def near_pairs(words: list[str]) -> Iterator[tuple[int, int, int]]:
    """(i, j, shared prefix) of the words exactly one edit apart, i < j, in a sorted list without repeats.

    A row of the edit matrix is kept as its three cells around the diagonal, by depth of the word being scanned."""
    n = len(words)
    lcp = [0] + [_shared(words[i - 1], words[i]) for i in range(1, n)]
    for i in range(n - 1):
        q, same = words[i], len(words[i])
        size = len(q)
        rows: list[tuple[int, int, int]] = [(2, 0, 1)]
        j, known = i + 1, 0
        while j < n:
            word = words[j]
            if lcp[j] <= same:  # it leaves the query's own path here: up to this depth the rows are those of equal words
                same = depth = lcp[j]
                row = (1, 0, 1) if depth else (2, 0, 1)
            else:
                depth = min(known, lcp[j])
                row = rows[depth]
            while len(rows) <= depth:
                rows.append((1, 0, 1))
            rows[depth] = row
            below, on, above = row
            dead = 0
            for depth in range(depth, len(word)):
                c = word[depth]
                first = min(on + 1, below + (0 < depth <= size and c != q[depth - 1])) if depth else on + 1
                second = min(first + 1, above + 1, on + (depth >= size or c != q[depth]))
                third = min(second + 1, above + (depth + 1 >= size or c != q[depth + 1]))
                below, on, above = first, second, third
                if len(rows) == depth + 1:
                    rows.append((below, on, above))
                else:
                    rows[depth + 1] = (below, on, above)
                if below > 1 and on > 1 and above > 1:
                    dead = depth + 1
                    break
            known = dead or len(word)
            if dead:
                j += 1
                while j < n and lcp[j] >= dead:
                    j += 1
                continue
            offset = size - len(word)
            if -1 <= offset <= 1 and (below, on, above)[offset + 1] == 1:
                yield i, j, same
            j += 1


def _scan(batches, max_list: int):
    """Scans each list of a task's sorted entries; a list beyond ``max_list`` is handed back, cut in two."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in _ENTRY_COLUMNS))

    out: list[tuple] = []
    for key, members in groupby(rows(), key=lambda r: r[0]):
        held: list[tuple] = []
        for row in members:
            held.append(row)
            if len(held) > max_list and row[5] > 1:
                break
        if len(held) > max_list and held[0][5] > 1:
            for part in (held, members):
                for row in part:
                    out += _halves(row)
                    if len(out) >= 10_000:
                        yield _batch(out)
                        out = []
            continue
        if len(held) > 1:
            out += _best(held)
        if len(out) >= 10_000:
            yield _batch(out)
            out = []
    yield _batch(out)


_FOUND = "found boolean, near long, form_n long, form string, " + _ENTRY
_FOUND_COLUMNS = [column.split()[0] for column in _FOUND.split(", ")]
_FOUND_TYPES = [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(),
                pa.int32(), pa.bool_()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _FOUND_TYPES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _FOUND_TYPES)], _FOUND_COLUMNS)


def _halves(row: tuple) -> list[tuple]:
    """The entry under two finer keys: if the edit is in the front half of the part, the back half is equal, and the reverse."""
    key, word, n, start, tail, span, last = row
    front = span // 2
    end = len(word) - tail
    back_tail = tail + span - front
    out = []
    for side, same, s, t, width, ends in (("f", word[len(word) - back_tail:end], start, back_tail, front, False),
                                          ("b", word[start:start + front], start + front, tail, span - front, last)):
        finer = int.from_bytes(blake2b(f"{key}{side}{same}".encode(), digest_size=8).digest(), "big", signed=True)
        out.append((False, None, None, None, finer, word, n, s, t, width, ends))
    return out


def _best(held: list[tuple]) -> list[tuple]:
    """For each word of a list that has near words in it: how many, and the commonest."""
    span, last = held[0][5], held[0][6]
    if all(len(r[1]) - r[3] - r[4] > span for r in held):
        return []  # the shorter word of a pair has just the part's length
    by_rest: dict[str, list[tuple]] = {}
    for row in held:
        by_rest.setdefault(row[1][row[3]:len(row[1]) - row[4]], []).append(row)
    rests = sorted(by_rest)
    found: dict[str, list] = {}
    for i, j, same in near_pairs(rests):
        if min(len(rests[i]), len(rests[j])) != span or (same >= span and not last):
            continue  # another list has this pair
        for a in by_rest[rests[i]]:
            for b in by_rest[rests[j]]:
                if a[1][:a[3]] != b[1][:b[3]] or a[1][len(a[1]) - a[4]:] != b[1][len(b[1]) - b[4]:]:
                    continue  # two keys with one hash
                for one, other in ((a, b), (b, a)):
                    now = found.setdefault(one[1], [0, 0, ""])
                    now[0] += 1
                    if (-other[2], other[1]) < (-now[1], now[2]) or not now[2]:
                        now[1:] = other[2], other[1]
    return [(True, near, n, form, None, word, None, None, None, None, None) for word, (near, n, form) in found.items()]


def near_words(words: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """(word, n_near, form_n, form) of the words of ``words`` (word, n) that have one at a single edit."""
    def scan(batches):
        return _scan(batches, cfg.max_list)

    todo, results, done = _entries(words, cfg), [], []
    while True:
        out = stored(todo.repartition("key").sortWithinPartitions("key").mapInArrow(scan, _FOUND), "near")
        done.append(out)
        results.append(out.where("found").select("word", "near", "form_n", "form"))
        todo = out.where("NOT found").select(*_ENTRY_COLUMNS)
        if todo.isEmpty():
            break
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.minus")).alias("form_n"), F.col("best.form").alias("form"))


# -- forms ------------------------------------------------------------------------------------

def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, the distance doubled in each round. A form has at least twice
    its word's occurrences, so a chain ends after a few dozen steps at most."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = now.join(ahead, F.col("root") == F.col("_at"), "left")
        new = stored(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        discard(now)
        moved = not new.where("_moved").isEmpty()
        now = new.drop("_moved")
        if not moved:
            return now


def variants(docs: DataFrame, cfg: SpellingConfig = SpellingConfig()) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs`` (doc_id, text): the form is the commonest near word (ties:
    the first in code-point order) if it has at least twice the occurrences, else null; the root is the end of the forms."""
    words = stored(word_counts(docs, cfg), "words")
    with_near = stored(words.join(near_words(words, cfg), "word", "left"), "near-words")
    formed = F.col("form_n") >= 2 * F.col("n")
    told = with_near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n"))
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
