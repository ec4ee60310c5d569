"""Files named by a list: only they are opened, by the tasks that read them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens import filesystem
from quirelens.operators.numbering import running_total

SLICE_BYTES = 32 << 20  # of files, as they are stored, that one task reads at most
SLICES_PER_CORE = 4  # where that leaves cores without a slice, or with one more than others
HELD_BYTES = 16 << 20  # of text handed on at a time


def file_paths(root: str) -> Column:
    """A scanned file's path below ``root``, from the scan's metadata.

    The metadata holds an encoded address, in which a plus sign stands for itself.
    """
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    base = urlsplit(root).path.rstrip("/") + "/"
    return F.substr(full, F.position(F.lit(base), full) + len(base))


def listed_paths(spark: SparkSession, list_path: str) -> DataFrame:
    """(path): the distinct lines of a list, without leading slashes and empty ones."""
    lines = spark.read.text(list_path).select(F.regexp_replace(F.trim("value"), r"^/+", "").alias("path"))
    return lines.filter(F.col("path") != "").distinct()


def sized(paths: DataFrame, input_dir: str, strict: bool, size_of: Callable[[str], int | None]) -> DataFrame:
    """(path, size) of the listed files below ``input_dir``; one that is not there fails the query when ``strict``."""
    root = input_dir.rstrip("/")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            sizes = [size_of(f"{root}/{name}") for name in names]
            missing = [name for name, size in zip(names, sizes) if size is None]
            if missing and strict:
                raise FileNotFoundError(f"listed file not found: {missing[0]}")
            there = [(name, size) for name, size in zip(names, sizes) if size is not None]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in there], pa.string()), pa.array([s for _, s in there], pa.int64())], ["path", "size"])

    return paths.mapInArrow(look, "path string, size long")


def read_paths(
    paths: DataFrame,
    input_dir: str,
    strict: bool = True,
    slice_bytes: int = SLICE_BYTES,
    size_of: Callable[[str], int | None] = filesystem.size_of,
    read: Callable[[str], bytes] = filesystem.read_bytes,
) -> DataFrame:
    """(path, json) of the files at different ``paths`` below ``input_dir``; see ``read_listed``."""
    root = input_dir.rstrip("/")
    found = running_total(sized(paths, input_dir, strict, size_of), ["path"], F.col("size"))
    total = found.agg(F.max(F.col("before") + F.col("size"))).first()[0] or 0
    slice_bytes = max(1, min(slice_bytes, -(-total // (SLICES_PER_CORE * paths.sparkSession.sparkContext.defaultParallelism))))
    slices = found.select("path", F.floor(F.col("before") / slice_bytes).cast("int").alias("slice"))
    last = max(0, total - 1) // slice_bytes  # a file without bytes may lie behind it

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(held: list[tuple[str, bytes]]) -> pa.RecordBatch:
            texts = pa.array([text for _, text in held], pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([pa.array([name for name, _ in held], pa.string()), texts], ["path", "json"])

        held: list[tuple[str, bytes]] = []
        size = 0
        for batch in batches:
            for name in batch.column("path").to_pylist():
                held.append((name, read(f"{root}/{name}")))
                size += len(held[-1][1])
                if size >= HELD_BYTES:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    return slices.repartitionById(last + 1, F.least(F.col("slice"), F.lit(last))).select("path").mapInArrow(opened, "path string, json string")


def read_listed(
    spark: SparkSession,
    list_path: str,
    input_dir: str,
    strict: bool = True,
    slice_bytes: int = SLICE_BYTES,
    size_of: Callable[[str], int | None] = filesystem.size_of,
    read: Callable[[str], bytes] = filesystem.read_bytes,
) -> DataFrame:
    """(path, json) of the files that a list names, each unpacked as its name says.

    The list is a table: its files' sizes are asked for in tasks, added up in the order of their paths, and cut into
    slices of about ``slice_bytes``, or less to give every core SLICES_PER_CORE; one task each. The folder is never
    listed, files that are not named are not opened, and neither list nor paths pass through the driver. A missing file fails the query when ``strict``, else it
    is left out; an unreadable one fails it always. ``size_of`` and ``read`` take a file's address and may be replaced
    where Arrow does not reach the store; ``records.scan_filelist`` reads through Spark alone, but opens every file.
    """
    return read_paths(listed_paths(spark, list_path), input_dir, strict, slice_bytes, size_of, read)
