"""What the operators share: intermediate tables, the held-out fold, byte-level word helpers, a fixed-size id filter."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(key: str, sql: str | None = None):
    """Register the decorated (spark, sf_dir) -> DataFrame under ``key``, with its SQL where there is one."""

    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = make
        if sql is not None:
            CHECKS[key] = sql
        return make

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables one run writes into the shared folder and reads again.

    The folder is ``spark.checkpoint.dir``; where that is unset, a folder beside the session's tables. A lost
    executor costs only the tasks in flight, because what was written does not depend on it. ``drop`` removes a
    table that nothing reads any more; what the returned DataFrame still reads stays in the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        self.spark, self.root = spark, f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, rows: DataFrame, name: str, *partition_by: str) -> DataFrame:
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``docs`` has it."""
    there = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in there:
            name = f"_{name}"
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """The fold no model learns from; a row without an id is in neither fold and counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 != 2, F.lit(False))


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sized_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.Table]:
    """The rows of a partition in tables of about ``most_bytes`` in one column, so that memory does not follow the row count.

    A batch is cut between rows; a single longer row makes a table of its own.
    """
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > most_bytes:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(kept)
                kept, held, start = [], 0, i
            held += n
        if start < batch.num_rows:
            kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def key_bits(keys: DataFrame, hashed: Column, most_log2: int = 23) -> np.ndarray:
    """A bit map of hashed keys (non-negative whole numbers), at most 2**most_log2 bits (a megabyte) whatever their number.

    Used inside a task to leave out rows early; a set bit proves nothing, so an exact join must follow.
    """
    log2 = min(most_log2, max(12, int(keys.count() * 16).bit_length()))
    words = (
        keys.select((hashed % (1 << log2)).alias("slot"))
        .select(F.shiftright("slot", 5).cast("int").alias("word"), (F.col("slot") % 32).cast("int").alias("bit"))
        .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .collect()
    )
    bits = np.zeros((1 << log2) >> 5, dtype=np.uint32)
    for row in words:
        bits[row.word] = row.bits
    return bits


def holds(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Which hashed keys may be in the map."""
    slots = hashed % (len(bits) * 32)
    return (bits[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1 == 1

