"""The answer store: answers kept between runs, apart per scope and model.

Every append writes one *run*, a folder of Parquet that is never changed; ``merge_runs`` runs of a level become one of the next, so
there are few of them and a merge reads one level. A run is cut into *pieces* by the first four digits of the key, a hash, so pieces
are even; each file is sorted by key. Beside it lies an *outline*: its number of rows and a bitmap of the key heads that it holds.
A look-up reads the pieces that both bitmaps allow, semi-joins them with the keys asked, and only then groups.

Clearing writes a marker: what was appended before it, of a scope or at all, is not seen any more, and goes at the next merge.
Only folders with a ``_SUCCESS`` marker count; a merged run replaces those it covers, which stay for their readers until ``vacuum``.

Each row carries ``seq``, the append that wrote it (the highest wins), and ``age``, the append that first wrote its key: replacing
an answer does not make it younger.

    <path>/run=<first>-<last>-<made>-<level>-<pieces>/piece=<n>/*.parquet    appends first..last, made as the made-th change
    <path>/outline=<first>-<last>-<made>                                     rows, bitmap of heads
    <path>/gone=<made>-<upto>-<digest of the scope, or all>                  an empty file
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from rowjudge.sources import files

SCHEMA = ("model string, scope string, set_key string, entry_key string, answers array<string>, seq bigint, "
          "age bigint")
COLUMNS = [column.split()[0] for column in SCHEMA.split(", ")]
_IDENTITY = ("model", "scope", "set_key", "entry_key")


def latest(log: DataFrame) -> DataFrame:
    """The newest answer of each key, with the age of its first."""
    return log.groupBy("entry_key").agg(
        *[F.first(c).alias(c) for c in _IDENTITY[:3]],
        F.max_by("answers", "seq").alias("answers"),
        F.max("seq").alias("seq"),
        F.min("age").alias("age"),
    )


def keep_youngest(entries: DataFrame, limit: int, *, age: str = "age", key: str = "entry_key") -> DataFrame:
    """First in, first out: keep the ``limit`` entries of highest age number, ties by key.

    There is no global sort and no join. Counts per age (one row per append) give the age at
    the border; counts per key prefix inside it give the border prefix; only that prefix, a
    65,536th of one append, is ranked row by row. Zero keeps everything.
    """
    if limit <= 0:
        return entries
    prefix = F.substring(key, 1, 4)
    ages = _border(entries.groupBy(F.col(age).alias("at")).agg(F.count(F.lit(1)).alias("n")), F.col("at").desc(),
                   F.lit(0), limit)
    at_border = F.col(age) == ages["at"]
    counts = entries.where(at_border).groupBy(prefix.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    prefixes = _border(counts, F.col("at").asc(), ages["before"], limit)
    fits = ages.isNull() | (F.col(age) > ages["at"]) | (at_border & (prefix < prefixes["at"]))
    rank = prefixes["before"] + F.row_number().over(Window.orderBy(key))
    edge = entries.where(at_border & (prefix == prefixes["at"])).withColumn("_rank", rank).where(F.col("_rank") <= limit)
    return entries.where(fits).unionByName(edge.drop("_rank"))


def _border(counts: DataFrame, order: Column, base: Column, limit: int) -> Column:
    """Of (at, n) in ``order``: the ``at`` in which the running total from ``base`` reaches
    ``limit``, and the total ``before`` it; NULL when it never does. A scalar subquery."""
    window = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.withColumn("upto", base + F.sum("n").over(window)).withColumn("before", F.col("upto") - F.col("n"))
    here = running.where((F.col("before") < limit) & (F.col("upto") >= limit))
    return here.select(F.struct("at", "before")).scalar()


#: Heads of keys: their first four hexadecimal digits.
HEADS = 1 << 16
MOST_PIECES = 1 << 12


class Run(NamedTuple):
    first: int
    last: int
    made: int
    level: int
    pieces: int

    @property
    def folder(self) -> str:
        return "run=" + "-".join(f"{n:09d}" for n in self[:3]) + f"-{self.level}-{self.pieces}"

    @property
    def outline(self) -> str:
        return "outline=" + "-".join(f"{n:09d}" for n in self[:3])

    def covers(self, other: "Run") -> bool:
        return self.made > other.made and self.first <= other.first and other.last <= self.last


class Gone(NamedTuple):
    made: int
    upto: int
    scope: str


def _head(key: str = "entry_key") -> Column:
    return F.conv(F.substring(key, 1, 4), 16, 10).cast("bigint")


def _bitmap_columns(head: str) -> list[Column]:
    """Both halves of the bitmap of heads; ``head`` names a column."""
    halves = (("low", f"{head} < 32768"), ("high", f"{head} >= 32768"))
    return [F.expr(f"bitmap_construct_agg(bitmap_bit_position(if({test}, {head} + 1, NULL)))").alias(name) for name, test in halves]


def _heads(low: bytes, high: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bytes(low) + bytes(high), np.uint8), bitorder="little").astype(bool)


def _digest(scope: str) -> str:
    return sha256(scope.encode()).hexdigest()


class AnswerStore:
    """One writer at a time: a second writer of the same run fails, it does not overwrite."""

    rows_per_file = 1_000_000
    merge_runs = 8

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- what there is ---------------------------------------------------------------------

    def _folders(self, pattern: str) -> list[Run]:
        found = [p.split("run=")[1].split("/")[0] for p in files.glob(self.spark, f"{self.path}/{pattern}")]
        return sorted(Run(*map(int, name.split("-"))) for name in found)

    def _finished(self) -> list[Run]:
        return self._folders("run=*/_SUCCESS")

    def _gone(self) -> list[Gone]:
        names = [p.split("gone=")[1] for p in files.glob(self.spark, f"{self.path}/gone=*")]
        return [Gone(int(made), int(upto), scope) for made, upto, scope in (name.split("-") for name in names)]

    def runs(self) -> list[Run]:
        """The runs that answers are read from: finished, not covered by a merged one, not cleared as a whole."""
        finished, gone = self._finished(), self._gone()
        everything = [g for g in gone if g.scope == "all"]
        return [r for r in finished if not any(other.covers(r) for other in finished)
                and not any(r.made < g.made and r.last <= g.upto for g in everything)]

    def _next(self) -> tuple[int, int]:
        """The next append's number, and the next change's; a folder that a dead writer left keeps its number."""
        every, gone = self._folders("run=*"), self._gone()
        return (max([r.last for r in every] + [g.upto for g in gone], default=0) + 1,
                max([r.made for r in every] + [g.made for g in gone], default=0) + 1)

    def _outline(self, run: Run) -> tuple[int, np.ndarray]:
        data = files.read_bytes(self.spark, f"{self.path}/{run.outline}")
        return int.from_bytes(data[:8], "little"), _heads(data[8:8 + HEADS // 16], data[8 + HEADS // 16:])

    def rows(self) -> int:
        """Rows kept, replaced and cleared ones among them, from the outlines alone."""
        return sum(self._outline(run)[0] for run in self.runs())

    def check_writable(self) -> None:
        """Raises before anything is paid for if answers couldn't be kept."""
        probe = f"{self.path}/_probe"
        files.touch(self.spark, probe)
        files.delete(self.spark, probe)

    # -- reading ---------------------------------------------------------------------------

    def _seen(self, folders: list[str], oldest: int) -> DataFrame:
        """The rows of these folders that no clearing hides; ``oldest`` is the first change that made one of them."""
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        found = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)
        gone = [g for g in self._gone() if g.made > oldest]
        upto = max((g.upto for g in gone if g.scope == "all"), default=0)
        if upto:
            found = found.where(F.col("seq") > upto)
        latest_of = {}
        for g in gone:
            if g.scope != "all" and g.upto > upto:
                latest_of[g.scope] = max(g.upto, latest_of.get(g.scope, 0))
        if latest_of:  # a short row for each scope cleared since the last merge
            markers = self.spark.createDataFrame(list(latest_of.items()), "_scope string, _upto bigint")
            hidden = (F.sha2("scope", 256) == F.col("_scope")) & (F.col("seq") <= F.col("_upto"))
            found = found.join(markers, hidden, "left_anti")
        return found

    def log(self, *, model: str | None = None, scope: str | None = None) -> DataFrame:
        """Every answer that is not cleared, replaced ones among them, pruned by model and scope."""
        runs = self.runs()
        found = self._seen([f"{self.path}/{r.folder}" for r in runs], min((r.made for r in runs), default=0))
        if model is not None:
            found = found.where(F.col("model") == model)
        if scope is not None:
            found = found.where(F.col("scope") == scope)
        return found.select(*COLUMNS)

    def latest(self, *, model: str | None = None, scope: str | None = None) -> DataFrame:
        return latest(self.log(model=model, scope=scope))

    def lookup(self, asked: DataFrame) -> DataFrame:
        """``latest`` for the keys of ``asked`` (entry_key), read twice: once for the bitmap of its heads. Only pieces that may
        hold one of them are read, and rows are semi-joined with the keys before they are grouped."""
        runs = self.runs()
        if not runs:
            return latest(self._seen([], 0))
        row = asked.where("entry_key IS NOT NULL").select(_head().alias("_head")).agg(*_bitmap_columns("_head")).first()
        wanted = _heads(row["low"], row["high"])
        folders = []
        for run in runs:
            heads = np.flatnonzero(wanted & self._outline(run)[1])
            folders += [f"{self.path}/{run.folder}/piece={n}" for n in np.unique(heads * run.pieces // HEADS)]
        found = self._seen(folders, min(run.made for run in runs))
        return latest(found.join(asked.select("entry_key"), "entry_key", "left_semi"))

    # -- writing ---------------------------------------------------------------------------

    def _write(self, entries: DataFrame, first: int, last: int, level: int, most_rows: int) -> int:
        """Writes a run and its outline; returns its rows. ``most_rows`` sizes its pieces."""
        pieces = 1
        while pieces * self.rows_per_file < most_rows and pieces < MOST_PIECES:
            pieces *= 2
        run = Run(first, last, self._next()[1], level, pieces)
        seen = Observation()
        piece = F.floor(F.col("_head") * pieces / HEADS).cast("int")
        dealt = entries.select(*COLUMNS, _head().alias("_head")).withColumn("piece", piece)
        dealt = dealt.observe(seen, F.count(F.lit(1)).alias("n"), *_bitmap_columns("_head")).drop("_head")
        folder = f"{self.path}/{run.folder}"
        (dealt.repartition(pieces, "piece").sortWithinPartitions("piece", "entry_key")
         .write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("piece").parquet(folder))
        told = seen.get
        files.write_bytes(self.spark, f"{self.path}/{run.outline}", told["n"].to_bytes(8, "little") + bytes(told["low"]) + bytes(told["high"]))
        files.touch(self.spark, f"{folder}/_SUCCESS")  # last: a run without its outline is not one
        return told["n"]

    def append(self, answers: DataFrame, rows: int) -> int:
        """Add answers (model, scope, set_key, entry_key, answers), about ``rows`` of them; returns the append's number."""
        number = self._next()[0]
        stamp = F.lit(number).cast("bigint")
        self._write(answers.withColumn("seq", stamp).withColumn("age", stamp), number, number, 0, rows)
        self._merge_full_levels()
        return number

    def _merge(self, runs: list[Run], level: int) -> int:
        kept = latest(self._seen([f"{self.path}/{r.folder}" for r in runs], min(r.made for r in runs)))
        return self._write(kept, min(r.first for r in runs), max(r.last for r in runs), level, sum(self._outline(r)[0] for r in runs))

    def _merge_full_levels(self) -> None:
        level = 0
        while True:
            same = [r for r in self.runs() if r.level == level]
            if len(same) < self.merge_runs:
                return
            self._merge(same, level + 1)
            level += 1

    def trim(self, max_entries: int) -> None:
        """Compact once more than ``max_entries`` answers are kept; zero never does."""
        if 0 < max_entries < self.rows():
            self.compact(max_entries)

    def compact(self, max_entries: int = 0) -> int:
        """Merge everything to one row per key, the oldest beyond ``max_entries`` dropped; returns the number of answers kept."""
        runs = self.runs()
        if not runs:
            return 0
        level = max(r.level for r in runs) + 1
        kept = self._merge(runs, level)
        if 0 < max_entries < kept:
            merged, = self.runs()
            entries = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/{merged.folder}")
            kept = self._write(keep_youngest(entries, max_entries), merged.first, merged.last, level, max_entries)
        return kept

    def clear(self, scope: str | None = None) -> bool:
        """Forget every answer, or those of one scope: one marker, no answer is read."""
        number, made = self._next()
        name = "all" if scope is None else _digest(scope)
        files.touch(self.spark, f"{self.path}/gone={made:09d}-{number - 1:09d}-{name}")
        return True

    def vacuum(self) -> None:
        """Drop runs that are covered or cleared, once nothing reads them any more, what dead writers left, and markers that
        hide nothing."""
        keep, gone = self.runs(), self._gone()
        newest = max([r.last for r in keep], default=0)
        for run in set(self._folders("run=*")) - set(keep):
            files.delete(self.spark, f"{self.path}/{run.folder}")
            files.delete(self.spark, f"{self.path}/{run.outline}")
        last_marker = max(gone, default=None)
        for g in gone:
            hides = any(r.made < g.made and r.first <= g.upto for r in keep)
            numbers = g == last_marker and g.upto > newest  # the next append's number is counted on from here
            if not hides and not numbers:
                files.delete(self.spark, f"{self.path}/gone={g.made:09d}-{g.upto:09d}-{g.scope}")
