"""Best-fit packing of documents into fixed-length sequences by linear grouping.

1. Tokenise: each document's ids and an end id; documents longer than a sequence are cut, the first piece takes the rest of
   the division. Each task numbers its pieces within their length; the pieces (not the ids) are written.
2. Count pieces by length: at most ``capacity`` numbers, whatever the size of the corpus. The plan is made of them alone:
   large lengths are sorted into ``groups`` groups of equal cardinality and rounded up to their group's largest; a linear
   program over the few sizes (column generation, patterns priced by a knapsack) gives configurations and how often to use
   each; the actual lengths take the rounded ones' places, whose true gaps are then known; what rounding left over and the
   small lengths go, longest first, to the tightest gap that holds them.
3. A plan says for runs of pieces of one length (by their number) which sequences and which offset they take, so every piece
   finds its place by one lookup. The number of runs depends on the number of lengths, not of documents.

Null texts count as empty: a document always has its end id, so empty and null ones are pieces of one token. Repeated rows
are packed each for itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowjudge.llm.common import stored, text_of


@dataclass(frozen=True)
class PackConfig:
    """tokenizer: path of a tokenizers file; large: lengths from here on are grouped."""

    tokenizer: str
    capacity: int = 1024
    end_id: int = 2
    large: int = 341
    groups: int = 128


# -- tokens -------------------------------------------------------------------------------------

#: The byte-level pre-tokenisation (fixed value).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in own}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}


class Encoder:
    """Ids of texts by a tokenizers file, without the tokens that it adds around a text; the strings of its added tokens are those.

    A byte-level BPE file whose ids follow its merges says the same as a table of ranks, which is read three times faster
    by another library; any other file is read by its own.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        vocab = model.get("vocab", {})
        plain = (model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not any(model.get(x) for x in ("continuing_subword_prefix", "end_of_word_suffix", "dropout", "ignore_merges"))
                 and all(vocab.get(x + y) == 256 + i for i, (x, y) in enumerate(merges)))
        added = {token["content"]: token["id"] for token in spec.get("added_tokens") or []}
        plain = (plain and not any(token.get(x) for token in spec.get("added_tokens") or [] for x in ("lstrip", "rstrip", "single_word"))
                 and not any(a != b and a in b for a in added for b in added))
        if plain:
            import tiktoken

            letters = _byte_letters()
            ranks = {bytes(letters[c] for c in word): i for word, i in vocab.items() if i < 256 + len(merges)}
            encoding = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=added)
            self._encode = lambda text: encoding.encode(text, allowed_special="all")
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self._encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encode(text), np.uint32)


_PIECE = "piece int, start long, length long, ids_crc32 long, part int, number long"


def _tokenise(cfg: PackConfig):
    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(cfg.capacity + 1, np.int64)
        encoder = Encoder(cfg.tokenizer)
        for batch in batches:
            doc, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.encode(text), np.uint32(cfg.end_id)).astype("<u4")
                at, piece, end = 0, 0, len(ids) % cfg.capacity or cfg.capacity
                while at < len(ids):
                    n = end - at
                    rows.append((piece, at, n, zlib.crc32(ids[at:end].tobytes()), seen[n]))
                    doc.append(i)
                    seen[n] += 1
                    at, end, piece = end, end + cfg.capacity, piece + 1
            cols = np.array(rows, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(cols[0].astype(np.int32)), pa.array(cols[1]),
                 pa.array(cols[2]), pa.array(cols[3]), pa.array(np.full(len(doc), part, np.int32)), pa.array(cols[4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"])
    return run


# -- the plan -----------------------------------------------------------------------------------

def configurations(sizes: list[int], need: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns over few sizes and how often to use each: a linear program solved by column generation.

    Each turn prices the sizes, finds the pattern of most worth by an unbounded knapsack, and pivots it into the basis. It
    ends when no pattern is worth 0.01 % more than a sequence, or after 10 turns a size: any basis is a valid plan.
    """
    k = len(sizes)
    order = np.argsort(sizes)
    size = np.array(sizes)[order]
    fits = [np.searchsorted(size, c, "right") for c in range(capacity + 1)]
    back = [c - size[: fits[c]] for c in range(capacity + 1)]
    columns = [np.eye(k)[i] * (capacity // s) for i, s in enumerate(sizes)]
    inverse = np.diag([1 / (capacity // s) for s in sizes])
    level = inverse @ need
    for _ in range(10 * k):
        value = inverse.sum(0)[order]
        best, by = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(size[0]), capacity + 1):
            gain = best[back[c]] + value[: fits[c]]
            j = int(gain.argmax())
            best[c], by[c] = (gain[j], j) if gain[j] > best[c - 1] + 1e-12 else (best[c - 1], -1)
        if best[capacity] <= 1.0001:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if by[c] >= 0:
                column[order[by[c]]] += 1
                c -= size[by[c]]
            else:
                c -= 1
        way = inverse @ column
        ratio = np.where(way > 1e-9, level / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
        level = np.maximum(level - way * ratio[out], 0)
        level[out] = ratio[out]
        columns[out] = column
    return [(c, float(x)) for c, x in zip(columns, level)]


class _Bins:
    """Runs of like sequences by the gap they have left: (gap, how many, [(length, first number, offset)])."""

    def __init__(self, capacity: int):
        self.capacity, self.by_gap = capacity, [[] for _ in range(capacity + 1)]

    def add(self, count: int, placed: list[tuple[int, int, int]]) -> None:
        if count:
            gap = self.capacity - sum(p[0] for p in placed)
            self.by_gap[gap].append((count, placed))

    def best_fit(self, length: int, first: int, count: int) -> None:
        gap = length
        while count:
            while gap <= self.capacity and not self.by_gap[gap]:
                gap += 1
            if gap > self.capacity:
                each = self.capacity // length
                self.by_gap[self.capacity].append((-(-count // each), []))
                gap = self.capacity
            n, placed = self.by_gap[gap].pop()
            take = min(n, count)
            if take < n:
                self.by_gap[gap].append((n - take, [(le, lo + take, off) for le, lo, off in placed]))
            self.by_gap[gap - length].append((take, placed + [(length, first, self.capacity - gap)]))
            first, count = first + take, count - take
            gap = length

    def runs(self) -> pd.DataFrame:
        rows, base = [], 0
        for group in self.by_gap:
            for count, placed in group:
                rows += [(le, lo, count, base, off) for le, lo, off in placed]
                base += count
        runs = pd.DataFrame(rows, columns=["length", "first", "count", "sequence", "offset"], dtype="int64")
        return runs.sort_values(["length", "first"], ignore_index=True)


def plan(counts: dict[int, int], cfg: PackConfig) -> pd.DataFrame:
    """Runs (length, first, count, sequence, offset) that place ``counts`` pieces of each length."""
    bins = _Bins(cfg.capacity)
    bins.add(counts.get(cfg.capacity, 0), [(cfg.capacity, 0, 0)])
    rest = {le: (0, n) for le, n in counts.items() if le < cfg.capacity and n}  # length: first number, how many
    large = sorted((le for le in rest if le >= cfg.large), reverse=True)
    total = sum(rest[le][1] for le in large)
    if total:
        # groups: each a list of [length, first number, how many], longest first
        groups, share, at = [], max(1, -(-total // cfg.groups)), 0
        for le in large:
            done, n = 0, rest[le][1]
            while done < n:
                if at % share == 0:
                    groups.append([])
                take = min(n - done, share - at % share)
                groups[-1].append([le, done, take])
                done, at = done + take, at + take
        sizes: dict[int, list] = {}
        for g in groups:  # groups that round to one size are one size of the program
            sizes.setdefault(g[0][0], []).extend(g)
        names = list(sizes)
        need = np.array([sum(x[2] for x in sizes[s]) for s in names], float)
        for column, level in configurations(names, need, cfg.capacity):
            slots = [names[i] for i in range(len(names)) for _ in range(int(column[i]))]
            times = min([int(level + 1e-6), *(sum(x[2] for x in sizes[s]) // slots.count(s) for s in set(slots))])
            while times > 0 and slots:
                heads, used = [], {}
                for s in slots:  # each slot reads on where the slot of the same size before it will end
                    heads.append((s, used.get(s, 0)))
                    used[s] = used.get(s, 0) + times
                cut, placed = times, []
                for s, skip in heads:
                    for le, first, n in sizes[s]:
                        if skip < n:
                            placed.append((le, first + skip))
                            cut = min(cut, n - skip)
                            break
                        skip -= n
                items, off = [], 0
                for le, first in placed:
                    items.append((le, first, off))
                    off += le
                bins.add(cut, items)
                for s, skip in sorted(heads, key=lambda h: -h[1]):  # from the back, so that no place before it moves
                    _take(sizes[s], skip, cut)
                times -= cut
        left: dict[int, list] = {}
        for s in names:
            for le, first, n in sizes[s]:
                if n:
                    left.setdefault(le, []).append((first, n))
        for le in sorted(left, reverse=True):
            for first, n in left[le]:
                bins.best_fit(le, first, n)
    for le in sorted((le for le in rest if le < cfg.large), reverse=True):
        bins.best_fit(le, *rest[le])
    return bins.runs()


def _take(pieces: list[list[int]], skip: int, n: int) -> None:
    """Remove ``n`` pieces after the first ``skip`` from a list of [length, first number, how many], within one entry."""
    for i, (le, first, many) in enumerate(pieces):
        if skip < many:
            pieces[i: i + 1] = [x for x in ([le, first, skip], [le, first + skip + n, many - skip - n]) if x[2] > 0]
            return
        skip -= many


def pack(docs: DataFrame, cfg: PackConfig) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    rows = docs.select("doc_id", text_of().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = stored(rows.mapInArrow(_tokenise(cfg), f"doc_id {kind}, {_PIECE}"), "pieces")
    own = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    own = stored(own.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    counts = {r["length"]: r["n"] for r in own.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, cfg)
    key = runs["length"].to_numpy() << 44 | runs["first"].to_numpy()  # numbers within a length stay below 2^44
    sequence, offset, first = (runs[c].to_numpy() for c in ("sequence", "offset", "first"))

    def place(batches):
        for pdf in batches:
            number = pdf["number"].to_numpy() + pdf["shift"].to_numpy()
            at = np.searchsorted(key, pdf["length"].to_numpy() << 44 | number, "right") - 1
            yield pdf.drop(columns=["number", "shift"]).assign(sequence_id=sequence[at] + number - first[at], offset=offset[at])

    numbered = pieces.join(own.drop("n"), ["part", "length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "number", "shift"]
    return numbered.select(*columns).mapInPandas(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
