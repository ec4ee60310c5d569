"""One file for every row, under the row's own path."""

from __future__ import annotations

import bz2
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from quirelens import filesystem

LISTED = "_listed"  # what was written, as lists that ``listed.read_listed`` takes
PENDING = "_pending"


def compressed(data: bytes) -> bytes:
    """bzip2 with the least block that surely holds all of a text: the same block, without memory for a larger one.

    Before blocks are cut, runs of four equal bytes may take five.
    """
    return bz2.compress(data, min(9, 1 + len(data) * 5 // 4 // 99_000))


@dataclass
class Written(WriterCommitMessage):
    """The list a task left, and how many files it names."""

    name: str
    n: int


class NamedFilesWriter(DataSourceArrowWriter):
    """Writes each file beside its name and renames it, so that a name never stands for half a file.

    Of a batch one text at a time becomes a Python object.

    A task that runs again writes the same files once more. What was written is listed by task; the lists of the tasks
    that counted are put into place when all have ended, so a folder without them holds an unfinished write.
    """

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}.txt"
        paths, last = [], None
        for batch in iterator:
            for path, json in zip(batch.column("path"), batch.column("json").cast(pa.binary())):
                path, data = path.as_py(), json.as_py()
                folder = posixpath.dirname(path)
                filesystem.publish(f"{self.root}/{path}", compressed(data) if path.endswith(".bz2") else data, there=folder == last)
                paths.append(path)
                last = folder
        if paths:
            filesystem.publish(f"{self.root}/{PENDING}/{name}", "".join(f"{p}\n" for p in paths).encode())
        return Written(name, len(paths))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for message in messages:
            if message and message.n:
                filesystem.move(f"{self.root}/{PENDING}/{message.name}", f"{self.root}/{LISTED}/{message.name}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """The files stay under their names, but no list names them."""


class NamedFiles(DataSource):
    """The sink ``named_files``: rows (path, json) below the folder of the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "path string, json string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return NamedFilesWriter(self.options["path"])


def write_named(files: DataFrame, root: str) -> str:
    """(path, json) rows as one file each below ``root``, bzip2-compressed where the path says so; returns the folder of lists."""
    files.sparkSession.dataSource.register(NamedFiles)
    files.select("path", "json").write.format("named_files").mode("append").option("path", root).save()
    return f"{root.rstrip('/')}/{LISTED}"
