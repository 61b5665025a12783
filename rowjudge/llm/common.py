"""What the training-data operators share: written tables, dense numbering, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowjudge.sources.files import delete, scratch_dir

_HOMES: dict[int, tuple[DataFrame, str]] = {}

#: What separates words everywhere in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch while a table is written: whole texts may be long, and two tasks share an executor's memory.
ARROW_ROWS = 2_000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ARROW_ROWS rows for the plans that are run within."""
    was = spark.conf.get(_ARROW_ROWS)
    if 0 < int(was) <= ARROW_ROWS:
        yield
        return
    spark.conf.set(_ARROW_ROWS, str(ARROW_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, was)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _HOMES[id(out)] = (out, path)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing reads any more. The shuffle files of the plans that wrote them go once the driver
    has collected those plans, which it is asked to do."""
    for df in tables:
        _, path = _HOMES.pop(id(df), (None, None))
        if path:
            delete(df.sparkSession, path)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def released(batches: Iterator) -> Iterator:
    """``batches``; when a task's are at an end, what Arrow and the allocator hold unused goes back to the machine."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_offsets(df: DataFrame, group: list[str], order: list[str], size: str | None = None) -> DataFrame:
    """Adds ``pos``: the running total of ``size`` (or the row's number) within ``group`` before the row, by ``order``.

    Rows are range-partitioned by group and order, so a hot group spreads over many tasks: each sums its own range, and the
    sums of the ranges (one row for each partition and group) shift them. The ranged table is written, so that the two
    reads of it agree.
    """
    one = F.col(size) if size else F.lit(1)
    n = conf_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *group, *order).withColumn("_pid", F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    before = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_in", F.coalesce(F.sum(one).over(before), F.lit(0)).cast("long"))
    totals = ranged.groupBy("_pid", *group).agg(F.sum(one).cast("long").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    if not group:
        earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    shift = totals.select("_pid", *group, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast("long").alias("_shift"))
    on = [F.col("l._pid") == F.col("r._pid")] + [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group]
    joined = inside.alias("l").join(shift.alias("r"), on)
    return joined.select("l.*", (F.col("l._in") + F.col("r._shift")).alias("pos")).drop("_pid", "_in")


# -- connected components ---------------------------------------------------------------------

def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and each one's smallest reachable node, for edges that fit in one task."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _forest(batches):
    """Replaces the edges of each batch by a star for each of its components: fewer edges, same components."""
    for pdf in batches:
        nodes, root = roots(pdf["a"].to_numpy(), pdf["b"].to_numpy())
        keep = nodes != root
        yield pd.DataFrame({"a": nodes[keep], "b": root[keep]})


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component_id): the smallest node reachable over ``edges`` (a, b: long), for nodes that have an edge.

    Alternating large-star and small-star steps: each is a minimum per node (combined before its shuffle) and a join back to
    the edges (which adaptive execution splits where a node is hot). Stops when a step changes nothing.
    """
    now = edges.select("a", "b").where("a <> b").mapInPandas(_forest, "a long, b long")
    now = stored(now.distinct(), "edges")
    sign = _signature(now)
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = small.groupBy("a").agg(F.min("b").alias("m"))
        step = small.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m")),
                                                               F.struct(F.col("b").alias("a"), F.col("m")))).alias("e"))
        step = step.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()
        last, now = now, stored(step, "edges")
        discard(last)
        was, sign = sign, _signature(now)
        if was == sign:
            break
    else:
        raise RuntimeError("components did not settle")
    ends = now.groupBy("a").agg(F.min("b").alias("component_id"))
    own = now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return ends.select(F.col("a").alias("node"), "component_id").union(own)


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)


def conf_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
