"""Folders through the session's Hadoop file system, and the run's scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, where, _ = _hadoop(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _hadoop(spark, path)
    return fs.exists(where)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in one call."""
    fs, where, _ = _hadoop(spark, pattern)
    return sorted(str(status.getPath()) for status in fs.globStatus(where) or [])


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, where, _ = _hadoop(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file, whole."""
    fs, where, jvm = _hadoop(spark, path)
    source = fs.open(where)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()


def make_dir(spark: SparkSession, path: str) -> None:
    fs, where, _ = _hadoop(spark, path)
    fs.mkdirs(where)


def touch(spark: SparkSession, path: str) -> None:
    fs, where, _ = _hadoop(spark, path)
    fs.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, where, _ = _hadoop(spark, path)
    fs.delete(where, True)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Without that setting a local session gets
    a temporary folder; a cluster has none to offer that all executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/") + "/rowjudge"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="rowjudge-")
    return _local_scratch


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table of the scratch space, so that what reads it again does not work it out again."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
