"""A sink that calls the judge: tasks send batches and commit the replies chunk by chunk, as they are paid for.

Each chunk is a Parquet file named after its batches, moved into place once it is whole. A task that is tried again finds the chunks
that its lost predecessor committed and sends the rest only, and whatever becomes of the job, what is in the folder is paid for and
whole. So one job sends everything, a lost executor costs at most ``chunk_rows`` batches per task, and twice-run tasks write the same
files. The folder is reached from the tasks through Arrow's file systems.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha1

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# What Hadoop and Arrow call the same store.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    for theirs, ours in _SCHEMES.items():
        if folder.startswith(theirs):
            folder = ours + folder[len(theirs):]
    return fs.FileSystem.from_uri(folder)


def supported(folder: str) -> bool:
    """Whether tasks can reach the folder without Spark's own writers."""
    try:
        file_system(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ImportError):
        return False
    return True


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows, wherever the batches are cut."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            batch = batch.slice(part.num_rows)
            held.append(part)
            n += part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Committed(WriterCommitMessage):
    chunks: int


class ReplyWriter(DataSourceArrowWriter):
    def __init__(self, call: Callable[[pa.Table], pa.Table], folder: str, chunk_rows: int):
        self.call, self.folder, self.chunk_rows = call, folder, chunk_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = file_system(self.folder)
        store.create_dir(root, recursive=True)
        done = 0
        for chunk in chunks(iterator, self.chunk_rows):
            name = sha1("\n".join(chunk.column("batch_id").to_pylist()).encode()).hexdigest()
            path = f"{root}/{name}.parquet"
            if store.get_file_info(path).type == fs.FileType.NotFound:
                draft = f"{root}/_{name}-{uuid.uuid4().hex}"
                pq.write_table(self.call(chunk), draft, filesystem=store)
                store.move(draft, path)
            done += 1
        return Committed(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = file_system(self.folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """What is committed is paid for, and stays."""


def write_replies(batches: DataFrame, call: Callable[[pa.Table], pa.Table], folder: str, chunk_rows: int) -> None:
    """One job: every partition's batches through ``call``, its results in ``folder``."""
    name = f"rowjudge_replies_{uuid.uuid4().hex}"

    class ReplySink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> ReplyWriter:
            return ReplyWriter(call, folder, chunk_rows)

    batches.sparkSession.dataSource.register(ReplySink)
    batches.write.format(name).mode("append").save()
