"""Packing token sequences by patterns of a few lengths, with repeat counts by non-negative least squares.

Lengths have few values, so the plan is made from their histogram alone: patterns of up to three lengths that fill a
sequence exactly are fitted to the counts, repeats are rounded, and what is left is packed best-fit, longest first,
still by count. Each piece gets its number among the pieces of its length, by counts for each part and not by a sort;
the plan then says its sequence and place. The plan's size depends on the sequence length only.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quirelens.llm.common import Scratch, query, sized_batches, table
from quirelens.llm.tokens import encoder

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BATCH_BYTES = 4 << 20
ROUNDS = 40
NEW_PATTERNS = 48  # joining the fit in a round
ROUNDINGS = (0.5, 0.6, 0.7, 0.8, 0.9, 0.999)  # fractions of a repeat from which it counts


def patterns_of(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All pairs and triples of the given lengths that sum to the capacity, ascending; a pair has 0 in front."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    there[0] = False
    first = np.concatenate(([0], np.flatnonzero(there)))
    out = []
    for a in first.tolist():
        low = max(a, 1)
        b = np.arange(low, (capacity - a) // 2 + 1)
        c = capacity - a - b
        fit = there[b] & there[c]
        out.append(np.stack([np.full(int(fit.sum()), a), b[fit], c[fit]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 3), dtype=np.int64)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares by an active set that grows by several patterns a round.

    Returns the rows of ``patterns`` in use and their repeats. Longer lengths weigh more, as they are harder to place.
    """
    size = len(counts)
    weight = np.arange(size) / size + 0.1
    target = counts * weight
    target[0] = 0.0
    active = np.zeros(0, dtype=np.int64)
    x = np.zeros(0)

    def matrix(rows: np.ndarray) -> np.ndarray:
        a = np.zeros((size, len(rows)))
        np.add.at(a, (patterns[rows].T, np.arange(len(rows))), 1.0)
        a[0] = 0.0
        return a * weight[:, None]

    for _ in range(ROUNDS):
        residual = target - (matrix(active) @ x if len(active) else 0.0)
        gain = (residual * weight)[patterns].sum(axis=1)
        gain[active] = 0.0
        best = np.argsort(-gain, kind="stable")[:4000]
        used, chosen = set(), []
        for p in best.tolist():
            if gain[p] <= 1e-3 or len(chosen) == NEW_PATTERNS:
                break
            mine = set(patterns[p].tolist()) - {0}
            if not mine & used:
                used |= mine
                chosen.append(p)
        if not chosen:
            break
        active = np.concatenate([active, np.array(chosen, dtype=np.int64)])
        while len(active):
            a = matrix(active)
            x = np.linalg.solve(a.T @ a + 1e-6 * np.eye(len(active)), a.T @ target)
            if (x > 0).all():
                break
            active = active[x > 0]
            x = x[x > 0]
    return active, x


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, repeats) that use every piece once.

    The patterns are fitted once. Fewer repeats than fitted leave more pieces for the residual, which fills gaps the
    patterns have; the fitted repeats are rounded at each of ROUNDINGS and the plan with fewest sequences is taken.
    """
    whole = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        whole[length] = n
    full = [((capacity,), int(whole[capacity]))] if whole[capacity] else []
    whole[capacity] = 0
    patterns = patterns_of(np.flatnonzero(whole), capacity)
    fitted: list[tuple[tuple[int, ...], float]] = []
    if len(patterns):
        rows, x = fit_repeats(patterns, whole.astype(float))
        fitted = [(tuple(v for v in patterns[rows[k]].tolist() if v), float(x[k])) for k in np.argsort(-x, kind="stable").tolist()]
    plans = []
    for up_from in ROUNDINGS:
        left, made = whole.copy(), list(full)
        for lengths, x_k in fitted:
            repeats = min(int(np.floor(x_k + 1 - up_from)), *[int(left[v]) // lengths.count(v) for v in lengths])
            if repeats > 0:
                made.append((lengths, repeats))
                for v in lengths:
                    left[v] -= repeats
        plans.append(made + best_fit(left, capacity))
    return min(plans, key=lambda made: sum(n for _, n in made))


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The longest remaining length goes to the open sequences with the least room for it, many alike at a time."""
    rooms: list[int] = []  # ascending
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], repeats: int) -> None:
        room = capacity - sum(lengths)
        if room not in open_at:
            open_at[room] = []
            insort(rooms, room)
        open_at[room].append((lengths, repeats))

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if n >= fit:
                    put((length,) * fit, n // fit)
                if n % fit:
                    put((length,) * (n % fit), 1)
                break
            room = rooms[at]
            lengths, repeats = open_at[room].pop()
            if not open_at[room]:
                del open_at[room]
                rooms.pop(at)
            fit = min(room // length, -(-n // repeats))  # as many as each takes, at least one
            filled = min(repeats, n // fit)
            if filled < repeats:
                put(lengths, repeats - filled)
            put(lengths + (length,) * fit, filled)
            n -= filled * fit
    return [entry for entries in open_at.values() for entry in entries]


def placements(made: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each place of each pattern: the length, the first of its pieces' numbers, the first sequence, the offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, repeats in made:
        offset = 0
        for length in lengths:
            number = used.get(length, 0)
            rows.append((length, number, sequence, offset))
            used[length] = number + repeats
            offset += length
        sequence += repeats
    table_ = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {"key": table_[:, 0] << 44 | table_[:, 1], "number": table_[:, 1], "sequence": table_[:, 2], "offset": table_[:, 3]}


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False, release: bool = False) -> DataFrame:
    """One row a piece: its document, place, length, checksum, and its number among those of its length in its part.

    A null text has the end id only. A longer document is cut into full pieces; a shorter piece, if any, comes first.
    """
    kind = docs.schema["doc_id"].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        numbers = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u2").tobytes()
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            out: dict[str, list] = {c: [] for c in ("row", "piece", "start", "length", "ids_crc32", "number", "ids")}
            for row, coded in enumerate(coder.encode([t or "" for t in rows.column("text").to_pylist()])):
                ids = np.frombuffer(coded + end, dtype="<u2").astype("<u4")
                start, length = 0, len(ids) % capacity or capacity
                piece = 0
                while start < len(ids):
                    own = ids[start:start + length].tobytes()
                    values = (row, piece, start, length, zlib.crc32(own), int(numbers[length]), own if with_ids else None)
                    for c, v in zip(out, values):
                        out[c].append(v)
                    numbers[length] += 1
                    start, length, piece = start + length, capacity, piece + 1
            taken = rows.column("doc_id").take(pa.array(out["row"], pa.int64())).combine_chunks()
            columns = [
                taken, pa.array(out["piece"], pa.int32()), *[pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")],
                pa.array(np.full(len(taken), part, dtype=np.int32)), pa.array(out["number"], pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(out["ids"], pa.binary())] * with_ids, names + ["ids"] * with_ids)
        if release:
            coder.release()

    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long, part int, number long" + ", ids binary" * with_ids
    )


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False, release: bool = False) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``, sequences without gaps from 0.

    Null and empty texts are pieces of one id. Repeated rows and ids are packed each for itself; an empty table gives
    no piece. Only ``doc_id`` and ``text`` are read. With ``with_ids`` the ids come along as 32-bit little-endian bytes.
    With ``release`` a task gives back the memory of its encoder, where executors have other work besides.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.write(pieces(docs, tokenizer, end_id, capacity, with_ids, release), "pieces")
    counts = scratch.write(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "counts")
    w = Window.partitionBy("length").orderBy("part")
    before = counts.select("part", "length", (F.sum("n").over(w) - F.col("n")).alias("before"))
    totals = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one a length
    sent = spark.sparkContext.broadcast(placements(plan(totals, capacity)))
    extra = ["ids"] * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = sent.value
        for rows in batches:
            length, number = (np.asarray(rows.column(c)) for c in ("length", "number"))
            at = np.searchsorted(places["key"], length << 44 | number, side="right") - 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *extra]
            columns = [rows.column(c) for c in names]
            columns += [pa.array(places["sequence"][at] + number - places["number"][at]), pa.array(places["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    numbered = cut.join(before, ["part", "length"]).withColumn("number", F.col("number") + F.col("before"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *extra]
    types = {f.name: f.dataType.simpleString() for f in cut.schema}
    schema = "".join(f"{c} {types[c]}, " for c in kept) + "sequence_id long, offset long"
    return numbered.select(*kept, "number").mapInArrow(place, schema)


@query("op8_pattern_packing")
def pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies."""
    return pack(table(spark, sf_dir, "documents"))
