"""Token ids in canonical, length-limited Huffman code, in blocks that are read on their own.

A first pass writes the ids and, at the end of each task, how often it wrote each. Code lengths come from the global counts by package-merge and are all a
reader needs: codes are canonical. Documents are dealt by ranges of their id, sorted, and written as blocks of whole
documents; a block holds its documents' lengths, the bit offset of every 256th id, and the bits. A reader looks up
the next bits of many such checkpoints at a time in one table. Blocks are rows of a table with binary payloads, so
any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quirelens.llm.common import Scratch, query, sized_batches, table
from quirelens.llm.tokens import encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
LONGEST_CODE = 18
CHECKPOINT = 256  # ids between two noted bit offsets
BLOCK_IDS = 1 << 20  # a block ends with the document that reaches this
BATCH_BYTES = 4 << 20
VOCABULARY = 1 << 16
HEADER = struct.Struct("<4sIQI")
MAGIC = b"CHB1"


def code_lengths(counts: np.ndarray, longest: int = LONGEST_CODE) -> np.ndarray:
    """Optimal lengths of at most ``longest`` bits for the ids with a count, by package-merge; 0 for the others."""
    lengths = np.zeros(len(counts), dtype=np.uint8)
    present = np.flatnonzero(counts)
    if len(present) > 1 << longest:
        raise ValueError("more ids than codes of this length")
    if len(present) < 2:
        lengths[present] = 1
        return lengths
    present = present[np.argsort(counts[present], kind="stable")]
    weights = counts[present].astype(np.int64)
    merged, single = weights, [np.ones(len(weights), dtype=bool)]
    for _ in range(longest - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")
        merged = both[order]
        single.append(order < len(weights))
    take = 2 * len(weights) - 2
    for flags in reversed(single):
        ids = int(flags[:take].sum())
        lengths[present[:ids]] += 1
        take = 2 * (take - ids)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id; 0 where the length is 0."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        own = lengths[order].astype(np.int64)
        longest = int(own.max())
        widths = np.int64(1) << (longest - own)
        starts = np.cumsum(widths) - widths
        codes[order] = (starts >> (longest - own)).astype(np.uint32)
    return codes


class Codec:
    """Codes and the reader's table for given code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths).astype(np.int64)
        self.bits = max(1, int(lengths.max(initial=0)))
        self.symbol = np.zeros(1 << self.bits, dtype=np.uint16)
        self.width = np.ones(1 << self.bits, dtype=np.uint8)
        used = np.flatnonzero(lengths)
        shift = self.bits - self.lengths[used]
        first, n = self.codes[used] << shift, np.int64(1) << shift
        at = np.repeat(first - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        self.symbol[at] = np.repeat(used, n)
        self.width[at] = np.repeat(self.lengths[used], n)

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bits as bytes, and the bit offset of every CHECKPOINT-th id."""
        widths = self.lengths[ids]
        ends = np.cumsum(widths)
        starts = ends - widths
        total = int(ends[-1]) if len(ids) else 0
        size = (total + 7) // 8
        words = np.zeros((total + 31) // 32 + 1, dtype=np.uint64)
        if total:
            # each code in the 64 bits from its 32-bit word on; codes that start in one word are added up together
            value = (self.codes[ids] << (64 - widths - (starts & 31))).view(np.uint64)
            at = starts >> 5
            first = np.flatnonzero(np.diff(at, prepend=-1))
            sums = np.add.reduceat(value, first)
            words[at[first]] = sums >> np.uint64(32)
            words[at[first] + 1] += sums & np.uint64(0xFFFFFFFF)
        return words.astype(">u4").view(np.uint8)[:size], starts[::CHECKPOINT].astype(np.int64)

    def unpack(self, data: np.ndarray, checkpoints: np.ndarray, total: int) -> np.ndarray:
        """The ids, read from all checkpoints side by side."""
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)]).astype(np.uint32)
        windows = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
        out = np.zeros((len(checkpoints), CHECKPOINT), dtype=np.uint16)
        at = checkpoints.copy()
        last = len(windows) - 1
        for k in range(CHECKPOINT):
            byte = np.minimum(at >> 3, last)
            key = (windows[byte] << (at & 7).astype(np.uint32)) >> np.uint32(32 - self.bits)
            out[:, k] = self.symbol[key]
            at += self.width[key]
        return out.reshape(-1)[:total]


def write_block(codec: Codec, ids: np.ndarray, sizes: list[int]) -> bytes:
    data, marks = codec.pack(ids)
    return b"".join([HEADER.pack(MAGIC, len(sizes), len(ids), len(marks)), np.array(sizes, dtype="<u4").tobytes(), marks.astype("<u8").tobytes(), data.tobytes()])


def read_block(codec: Codec, block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each document)."""
    magic, docs, total, marks = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    at = HEADER.size
    sizes = np.frombuffer(block, dtype="<u4", count=docs, offset=at)
    at += 4 * docs
    offsets = np.frombuffer(block, dtype="<u8", count=marks, offset=at).astype(np.int64)
    return codec.unpack(np.frombuffer(block, dtype=np.uint8, offset=at + 8 * marks), offsets, total), sizes


def encode_ids(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, seen) with ids as 16-bit little-endian bytes, the end id last; a null text has that one only.

    Each task ends with a row of its own, in which only ``seen`` is not null: how often it wrote each id of the
    vocabulary, as 64-bit little-endian numbers.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer), np.array([end_id], dtype="<u2").tobytes()
        total = np.zeros(VOCABULARY, dtype="<i8")
        names = ["doc_id", "ids", "seen"]
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            coded = [c + end for c in coder.encode([t or "" for t in rows.column("text").to_pylist()])]
            total += np.bincount(np.frombuffer(b"".join(coded), dtype="<u2"), minlength=VOCABULARY)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id").combine_chunks(), pa.array(coded, pa.binary()), pa.nulls(len(coded), pa.binary())], names)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids binary, seen binary")


def id_counts(coded: DataFrame) -> np.ndarray:
    """How often each id occurs: the tasks' own counts added up, so no more than the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, dtype=np.int64)
        for rows in batches:
            for own in rows.column("seen"):
                total += np.frombuffer(own.as_py(), dtype="<i8")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["id", "n"])

    told = coded.select("seen").filter(F.col("seen").isNotNull())
    found = told.mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(VOCABULARY, dtype=np.int64)
    for r in found:
        counts[r.id] = r.n
    return counts


def write_blocks(coded: DataFrame, lengths: np.ndarray, parts: int) -> DataFrame:
    """Block rows (file, block, first, n_ids, doc_ids, payload), files and blocks in ascending doc_id order (nulls first)."""
    sent = coded.sparkSession.sparkContext.broadcast(lengths)  # a byte for each id of the vocabulary

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, file = Codec(sent.value), TaskContext.get().partitionId()
        held: list[bytes] = []
        names: list[int | None] = []
        state = {"block": 0, "first": 0, "ids": 0}

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u2")
            payload = write_block(codec, ids, [len(x) // 2 for x in held])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()), pa.array([state["block"]], pa.int32()), pa.array([state["first"]], pa.int64()),
                    pa.array([len(ids)], pa.int64()), pa.array([list(names)], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
                ],
                ["file", "block", "first", "n_ids", "doc_ids", "payload"],
            )
            state.update(block=state["block"] + 1, first=state["first"] + len(ids), ids=0)
            held.clear()
            names.clear()
            return row

        for rows in batches:
            for name, ids in zip(rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist()):
                held.append(ids)
                names.append(name)
                state["ids"] += len(ids) // 2
                if state["ids"] >= BLOCK_IDS:
                    yield flush()
        if held:
            yield flush()

    ordered = coded.filter(F.col("ids").isNotNull()).select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    return ordered.mapInArrow(write, "file int, block int, first long, n_ids long, doc_ids array<long>, payload binary")


def read_documents(blocks: DataFrame, lengths: np.ndarray) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the blocks."""
    sent = blocks.sparkSession.sparkContext.broadcast(lengths)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(sent.value)
        for rows in batches:
            for k in range(rows.num_rows):
                ids, sizes = read_block(codec, rows.column("payload")[k].as_py())
                ends = np.cumsum(sizes.astype(np.int64))
                wide = ids.astype("<u4")
                sums = [zlib.crc32(wide[e - s:e].tobytes()) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(sizes), rows.column("file")[k].as_py(), dtype=np.int32)), rows.column("doc_ids")[k].values,
                        pa.array(ends - sizes + rows.column("first")[k].as_py()), pa.array(sizes.astype(np.int64)), pa.array(sums, pa.int64()),
                    ],
                    ["file", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    docs = blocks.select("file", "first", "doc_ids", "payload").mapInArrow(read, "file int, doc_id long, at long, n_tokens long, ids_crc32 long")
    totals = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before"))  # a row a file
    return docs.join(before, "file").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Writes every document's ids in the file format and returns what reading the files back gives.

    Null and empty texts have the end id only. Repeated ids keep all their rows, side by side. An empty table gives
    no file and no row. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "huffman")
    coded = scratch.write(encode_ids(docs, tokenizer, end_id), "ids")
    lengths = code_lengths(id_counts(coded))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = scratch.write(write_blocks(coded, lengths, parts), "blocks")
    scratch.drop("ids")
    code = scratch.write(spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary"), "code")
    stored = np.frombuffer(bytes(code.first().lengths), dtype=np.uint8)
    return read_documents(blocks, stored)


@query("op9_huffman_ids")
def huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written and read back."""
    return round_trip(table(spark, sf_dir, "documents"))
