"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

Documents come in batches, ascending by id. A batch gets a suffix array: each task sorts the suffixes of the texts it
holds, then one scan in the order of the suffixes' leading bytes merges the tasks' arrays with those of the existing
levels. Suffixes that agree lie side by side there, and the newer one's text is a repeat. Where the new array is as
large as the last level, the same scan writes them as one of twice the size, and so on upwards, so a suffix is
rewritten a logarithmic number of times.

The arrays are sparse. Of every MATCH-byte string one suffix is kept, chosen by hashes of the string's own bytes, so
two equal strings keep the same one and meet in the order. An entry stands for the strings next to each other that
share their kept suffix: its leading bytes, a hash of all bytes those strings cover, and where they start. Entries
that agree in both are copies, and what the later covers goes. Entries that agree in the leading bytes only are
compared string by string on the texts, once, at the end. That covers every string of the input, so the result is
exact (but for equal hashes: of 64 bits among the strings of one suffix, else of 128).

A task hands on one entry of each kind, and of a suffix with many kinds a fixed number, so that common passages
reach the merge as a few entries from each task. Suffixes with very many kinds are not compared in one task: their
strings are dealt by hash, one of each from a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import Scratch, query, sized_batches, table

MATCH = 100
PREFIX = 24  # leading bytes of a suffix that order it: three numbers of eight bytes
REACH = MATCH - PREFIX + 1  # places among which a string's kept suffix is chosen
BATCHES = 3
KINDS = 8  # entries of one suffix that a task or level hands on
PIECE_BITS = 20
PIECE = 1 << PIECE_BITS  # bytes that are hashed at once
ARRAY_BYTES = 24 << 20  # text that a task sorts at once
COMPARED = 1_000_000  # strings that a task compares at once
TOGETHER = 2000  # entries of one suffix that are compared in one task
NO_ID = -(1 << 63)

ENTRY = ["k0", "k1", "k2", "kind", "doc", "at", "n"]
ENTRY_DDL = "k0 long, k1 long, k2 long, kind long, doc long, at int, n int, listed boolean, what int"
SUFFIX = ENTRY[:3]
# what an entry row is: n bytes to remove from ``at``; n strings to compare; an entry of an array
GONE, ASKED, KEPT = 0, 1, 2
SPANS_DDL = "array<struct<start: int, stop: int>>"

_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, base, dtype=np.uint64))))


class Hashes:
    """Position-free 64-bit hashes of byte ranges of a buffer; two independent ones by ``seed``."""

    _tables: dict[str, np.ndarray] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        kept = self._tables
        if "up" not in kept:
            kept["up"], kept["down"] = _powers(_BASE, 2 * PIECE), _powers(_INVERSE, 2 * PIECE)
        if f"bytes{seed}" not in kept:
            kept[f"bytes{seed}"] = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 64, 256, dtype=np.uint64)
        self.down = kept["down"]
        with np.errstate(over="ignore"):
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(kept[f"bytes{seed}"][data] * kept["up"][:len(data)], dtype=np.uint64)))

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[stop] - self.sums[start]) * self.down[start])


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def pieces(docs: list[int], texts: list[bytes], overlap: int = MATCH - 1) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (doc, place in it, bytes) of at most PIECE bytes together; longer texts are cut so that no string is lost."""
    out, held = [], 0
    for doc, text in zip(docs, texts):
        for at in range(0, max(1, len(text) - overlap), PIECE - overlap):
            own = text[at:at + PIECE]
            if len(own) < MATCH:
                continue
            if held + len(own) > PIECE:
                yield out
                out, held = [], 0
            out.append((doc, at, own))
            held += len(own)
    if out:
        yield out


def kept_suffixes(data: np.ndarray, hashes: Hashes) -> np.ndarray:
    """For each place where a MATCH-byte string starts: where its kept suffix does (least hash, leftmost of equal ones)."""
    n = len(data) - PREFIX + 1
    least = hashes.of(slice(0, n), slice(PREFIX, PREFIX + n)) >> np.uint64(PIECE_BITS) << np.uint64(PIECE_BITS) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = REACH - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    return (least & np.uint64(PIECE - 1)).astype(np.int64)


def entries(docs: list[int], texts: list[bytes]) -> dict[str, np.ndarray]:
    """The entries of texts, unsorted: every MATCH-byte string is in one of them."""
    made: dict[str, list[np.ndarray]] = {c: [] for c in ENTRY}
    for part in pieces(docs, texts):
        data = np.frombuffer(b"".join(p[2] for p in part), dtype=np.uint8)
        lengths = np.array([len(p[2]) for p in part])
        stops = np.cumsum(lengths)
        hashes = Hashes(data)
        kept = kept_suffixes(data, hashes)
        starts = np.flatnonzero(np.arange(len(kept)) + MATCH <= np.repeat(stops, lengths)[:len(kept)])
        kept = kept[starts]
        first = np.flatnonzero(np.concatenate(([True], (kept[1:] != kept[:-1]) | (starts[1:] != starts[:-1] + 1))))
        n = np.diff(np.append(first, len(starts)))
        start, suffix = starts[first], kept[first]
        whole = hashes.of(start, start + n + MATCH - 1)
        with np.errstate(over="ignore"):
            kind = mixed(whole + (n << 8 | suffix - start).astype(np.uint64) * np.uint64(_BASE))
        row = np.searchsorted(stops, start, side="right")
        eight = np.lib.stride_tricks.sliding_window_view(data, 8)
        for k in range(3):
            made[f"k{k}"].append((np.ascontiguousarray(eight[suffix + 8 * k]).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64))
        made["kind"].append(kind.view(np.int64))
        made["doc"].append(np.array([p[0] for p in part], dtype=np.int64)[row])
        made["at"].append((start - (stops - lengths)[row] + np.array([p[1] for p in part])[row]).astype(np.int32))
        made["n"].append(n.astype(np.int32))
    return {c: np.concatenate(v) if v else np.zeros(0, dtype=np.int64) for c, v in made.items()}


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """True where a row differs from the one before."""
    out = np.zeros(len(columns[0]), dtype=bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def united(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans by document with those that touch or overlap put together."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order].astype(np.int64), stop[order].astype(np.int64)
    lift = (np.cumsum(_changes([doc])) - 1) << 34
    reach = np.maximum.accumulate(stop + lift)
    fresh = np.concatenate(([True], start[1:] + lift[1:] > reach[:-1])) | _changes([doc])
    at = np.flatnonzero(fresh)
    return doc[at], start[at], (reach - lift)[np.append(at[1:], len(doc)) - 1]


def _rows(what: int, doc: np.ndarray, at: np.ndarray, n: np.ndarray, keys: list[np.ndarray] | None = None, listed: np.ndarray | None = None) -> pa.RecordBatch:
    """Entry rows of one sort; ``keys`` are the suffix and, for entries of an array, the kind."""
    size = len(doc)
    columns = [pa.array(k) for k in keys or []]
    columns += [pa.nulls(size, pa.int64())] * (4 - len(columns))
    columns += [pa.array(doc), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))]
    columns += [pa.array(listed if listed is not None else np.zeros(size, dtype=bool)), pa.array(np.full(size, what, dtype=np.int32))]
    return pa.RecordBatch.from_arrays(columns, [*ENTRY, "listed", "what"])


def _gone(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    doc, start, stop = united(doc, start, stop)
    return _rows(GONE, doc, start, stop - start)


def part_array(docs: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The suffix array of some texts, and the repeats and comparisons that show within them."""
    e = entries(docs, texts)
    if not len(e["doc"]):
        return
    order = np.lexsort([e[c] for c in ("at", "doc", "kind", "k2", "k1", "k0")])
    e = {c: v[order] for c, v in e.items()}
    suffix = _changes([e[c] for c in SUFFIX])
    kind = suffix | _changes([e["kind"]])
    first = np.flatnonzero(kind)
    own = first[np.cumsum(kind) - 1]
    later = (e["doc"] != e["doc"][own]) | (e["at"] != e["at"][own])  # a repeated row is not a repeat
    if later.any():
        yield _gone(e["doc"][later], e["at"][later], (e["at"] + e["n"] + (MATCH - 1))[later])
    group = np.cumsum(suffix)[first] - 1
    many = (np.bincount(group) > KINDS)[group]
    if many.any():
        rows = first[many]
        yield _rows(ASKED, *[e[c][rows] for c in ("doc", "at", "n")], [e[c][rows] for c in SUFFIX])
    place = np.arange(len(first)) - np.flatnonzero(_changes([group]))[group]
    handed = ~many | (place < KINDS)
    rows = first[handed]
    yield _rows(KEPT, *[e[c][rows] for c in ("doc", "at", "n")], [e[c][rows] for c in ENTRY[:4]], many[handed])


def _part_arrays(array_bytes: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized_batches(batches, "text", array_bytes):
            yield from part_array(part.column("doc").to_pylist(), [t or b"" for t in part.column("text").to_pylist()])

    return made


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows in tables that never end within a group of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(c)) for c in keys]
        tail = np.ones(batch.num_rows, dtype=bool)
        for c in columns:
            tail &= c == c[-1]
        begin = batch.num_rows - int(tail.sum())
        if begin:
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
            held = [batch.slice(begin)]
        elif held and any(held[0].column(c)[0].as_py() != v[-1] for c, v in zip(keys, columns)):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _arrays(rows: pa.Table, names: list[str]) -> dict[str, np.ndarray]:
    return {c: rows.column(c).to_numpy() for c in names}


def _merge_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The new array and the levels in one order: what repeats, what must be compared on the texts, and the merged array.

    Suffixes with several kinds of entries are compared if a new entry is among them; the old ones only if they were
    of one kind before, as otherwise they were handed on already. Of rows to ``merge``, the earliest of each kind is
    written, and of a suffix with many kinds the first KINDS.
    """
    for rows in whole_groups(batches, SUFFIX):
        e = _arrays(rows, [*ENTRY, "listed", "fresh", "merge"])
        suffix = _changes([e[c] for c in SUFFIX])
        kind = suffix | _changes([e["kind"]])
        first = np.flatnonzero(kind)
        number = np.cumsum(kind) - 1
        own = first[number]
        later = e["fresh"] & ((e["doc"] != e["doc"][own]) | (e["at"] != e["at"][own]))
        if later.any():
            yield _gone(e["doc"][later], e["at"][later], (e["at"] + e["n"] + (MATCH - 1))[later])
        group = np.cumsum(suffix)[first] - 1
        several = (np.bincount(group) > 1)[group]
        was = np.bincount(group, weights=np.logical_or.reduceat(~e["fresh"], first)).astype(int)
        news = np.logical_or.reduceat(e["fresh"], np.flatnonzero(suffix))
        asked = several & news[group] & ~e["listed"][first] & (e["fresh"][first] | (was == 1)[group])
        at = first[asked]
        if len(at):
            yield _rows(ASKED, *[e[c][at] for c in ("doc", "at", "n")], [e[c][at] for c in SUFFIX])
        merged = np.flatnonzero(e["merge"])
        if len(merged):
            merged = merged[_changes([number[merged]])]
            group_of = group[number[merged]]
            begins = np.flatnonzero(_changes([group_of]))
            place = np.arange(len(merged)) - begins[np.cumsum(_changes([group_of])) - 1]
            merged = merged[place < KINDS]
            listed = e["listed"][merged] | several[number[merged]]
            yield _rows(KEPT, *[e[c][merged] for c in ("doc", "at", "n")], [e[c][merged] for c in ENTRY[:4]], listed)


class Family:
    """The levels, each a suffix array of a power of two of batches, and what was found so far."""

    def __init__(self, scratch: Scratch, array_bytes: int = ARRAY_BYTES):
        self.scratch, self.array_bytes = scratch, array_bytes
        self.levels: list[tuple[int, str, DataFrame]] = []  # (batches in it, name, rows), oldest and largest first
        self.found: list[DataFrame] = []
        self.made = 0

    def add(self, docs: DataFrame, last: bool = False) -> None:
        """Take a batch (doc, text as bytes) whose documents are later than all before; after the ``last`` no array is kept."""
        self.made += 1
        name = f"batch-{self.made}"
        made = self.scratch.write(docs.mapInArrow(_part_arrays(self.array_bytes), ENTRY_DDL), name, "what")
        array, size, equal = made.filter(F.col("what") == KEPT).drop("what"), 1, []
        while self.levels and self.levels[-1][0] == size and not last:
            equal.append(self.levels.pop())
            size *= 2
        every = array.withColumn("fresh", F.lit(True)).withColumn("merge", F.lit(bool(equal)))
        for levels, merge in ((equal, True), (self.levels, False)):
            for _, _, level in levels:
                every = every.unionByName(level.withColumn("fresh", F.lit(False)).withColumn("merge", F.lit(merge)))
        order = [*SUFFIX, "kind", "doc", "at"]
        scanned = every.repartition(*SUFFIX).sortWithinPartitions(*order).mapInArrow(_merge_scan, ENTRY_DDL)
        seen = self.scratch.write(scanned, f"scan-{self.made}", "what")
        self.found += [seen.filter(F.col("what") != KEPT), made.filter(F.col("what") != KEPT)]
        # what was found stays when the arrays beside it go
        arrays, scan = f"{name}/what={KEPT}", f"scan-{self.made}/what={KEPT}"
        if equal:
            self.levels.append((size, scan, seen.filter(F.col("what") == KEPT).drop("what")))
        elif not last:
            self.levels.append((1, arrays, array))
        if equal or last:
            self.scratch.drop(arrays)
        for _, old, _ in [*equal, *(self.levels if last else [])]:
            self.scratch.drop(old)

    def results(self) -> DataFrame:
        """The rows of all batches that are not entries of an array."""
        out = self.found[0]
        for more in self.found[1:]:
            out = out.unionByName(more)
        return out.drop("kind", "listed")


def _strings(some: list[tuple[int, int, bytes]], seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash, the row and the place of every MATCH-byte string of a list of ``pieces``."""
    data = np.frombuffer(b"".join(p[2] for p in some), dtype=np.uint8)
    lengths = np.array([len(p[2]) for p in some])
    stops = np.cumsum(lengths)
    at = np.flatnonzero(np.arange(len(data)) + MATCH <= np.repeat(stops, lengths))
    row = np.searchsorted(stops, at, side="right")
    base = np.array([p[1] for p in some])
    return Hashes(data, seed).of(at, at + MATCH), np.array([p[0] for p in some])[row], at - (stops - lengths)[row] + base[row]


def _later(columns: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of sorted rows that agree in the columns: those elsewhere than the first."""
    new = _changes(columns)
    own = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (doc != doc[own]) | (at != at[own])


def _ask_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of entries to compare (k0, k1, k2, doc, at, bytes), and of suffixes with very many the strings' hashes
    (a, b, doc, at), of equal ones in a task the first, with the others as bytes to remove (doc, at, n)."""
    names = [*SUFFIX, "a", "b", "doc", "at", "n", "bytes", "what"]
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.int32(), pa.binary(), pa.int32()]

    def made(what: int, **columns) -> pa.RecordBatch:
        size = len(columns["doc"])
        columns["what"] = np.full(size, what)
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in zip(names, kinds)], names)

    def hashed(kept: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        a, b, doc, at = (np.concatenate(c) for c in zip(*kept))
        order = np.lexsort((at, doc, b, a))
        a, b, doc, at = a[order], b[order], doc[order], at[order]
        first, later = _changes([a, b]), _later([a, b], doc, at)
        yield made(KEPT, a=a[first], b=b[first], doc=doc[first], at=at[first])
        d, start, stop = united(doc[later], at[later], at[later] + MATCH)
        yield made(GONE, doc=d, at=start, n=stop - start)

    kept: list[tuple[np.ndarray, ...]] = []
    held = 0
    for part in sized_batches(batches, "text", 4 << 20):
        few: dict[str, list] = {c: [] for c in (*SUFFIX, "doc", "at", "bytes")}
        many: list[tuple[int, int, bytes]] = []
        for doc, text, ranges in zip(*[part.column(c).to_pylist() for c in ("doc", "text", "ranges")]):
            for r in ranges:
                # a row that repeats an id may be shorter than the one the range is of
                own = (text or b"")[r["at"]:r["at"] + r["n"] + MATCH - 1]
                if len(own) < MATCH:
                    continue
                if r["many"]:
                    many.append((doc, r["at"], own))
                else:
                    for c, v in zip(few, (*[r[k] for k in SUFFIX], doc, r["at"], own)):
                        few[c].append(v)
        if few["doc"]:
            yield made(ASKED, **few)
        for some in pieces(list(range(len(many))), [m[2] for m in many]):
            (a, row, at), (b, _, _) = _strings(some, 1), _strings(some, 2)
            docs, starts = (np.array([m[k] for m in many], dtype=np.int64) for k in (0, 1))
            kept.append((a.view(np.int64), b.view(np.int64), docs[row], at + starts[row]))
            held += len(a)
            if held >= COMPARED:
                yield from hashed(kept)
                kept, held = [], 0
    if kept:
        yield from hashed(kept)


def _compare_few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of entries, sorted by suffix, to what an earlier string of the same suffix equals."""

    def compared(tables: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(tables)
        e = _arrays(rows, [*SUFFIX, "doc", "at"])
        suffix = np.cumsum(_changes([e[c] for c in SUFFIX])).astype(np.uint64)
        order = np.lexsort((e["at"], e["doc"]))
        texts = rows.column("bytes").to_pylist()
        h, row, at = (np.concatenate(c) for c in zip(*(_strings(some, 1) for some in pieces(order.tolist(), [texts[i] for i in order.tolist()]))))
        with np.errstate(over="ignore"):
            h = mixed(h ^ suffix[row] * np.uint64(_BASE))
        doc, at = e["doc"][row], e["at"][row] + at
        by_hash = np.argsort(h, kind="stable")  # places stay in order
        doc, at = doc[by_hash], at[by_hash]
        later = _later([h[by_hash]], doc, at)
        return _gone(doc[later], at[later], at[later] + MATCH)

    held, size = [], 0
    for rows in whole_groups(batches, SUFFIX):
        held.append(rows)
        size += rows.num_rows * REACH // 2
        if size >= COMPARED:
            yield compared(held)
            held, size = [], 0
    if held:
        yield compared(held)


def _compare_many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of strings, sorted, to those equal to an earlier one."""
    first = None  # of the group that the last batch ended in
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, doc, at = (np.asarray(batch.column(c)) for c in ("a", "b", "doc", "at"))
        if first is not None:
            a, b, doc, at = (np.concatenate(([f], c)) for f, c in zip(first, (a, b, doc, at)))
        new = _changes([a, b])
        later = _later([a, b], doc, at)
        first = tuple(c[np.flatnonzero(new)[-1]] for c in (a, b, doc, at))
        if later.any():
            yield _gone(doc[later], at[later], at[later] + MATCH)


def compared(docs: DataFrame, asked: DataFrame, scratch: Scratch, together: int = TOGETHER) -> DataFrame:
    """(doc, at, n) of bytes to remove: of strings in the asked entries, those that equal an earlier one."""
    large = asked.groupBy(*SUFFIX).agg(F.count("*").alias("size")).filter(F.col("size") > together)
    sized = asked.join(large, SUFFIX, "left").withColumn("many", F.col("size").isNotNull())
    # no more than the text is long
    ranges = sized.groupBy("doc").agg(F.collect_set(F.struct(*SUFFIX, "at", "n", "many")).alias("ranges"))
    made = docs.join(ranges, "doc").mapInArrow(_ask_texts, "k0 long, k1 long, k2 long, a long, b long, doc long, at int, n int, bytes binary, what int")
    made = scratch.write(made, "texts", "what")
    few = made.filter(F.col("what") == ASKED).select(*SUFFIX, "doc", "at", "bytes")
    few = few.repartition(*SUFFIX).sortWithinPartitions(*SUFFIX).mapInArrow(_compare_few, ENTRY_DDL)
    many = made.filter(F.col("what") == KEPT).select("a", "b", "doc", "at")
    many = many.repartition("a", "b").sortWithinPartitions("a", "b", "doc", "at").mapInArrow(_compare_many, ENTRY_DDL)
    gone = made.filter(F.col("what") == GONE)
    return gone.select("doc", "at", "n").unionByName(few.select("doc", "at", "n")).unionByName(many.select("doc", "at", "n"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sized_batches(batches, "text", 4 << 20):
        sizes, spans, kept = [], [], []
        for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist()):
            text = text or b""
            rows = np.array([(s["at"], min(s["at"] + s["n"], len(text))) for s in found or [] if s["at"] < len(text)], dtype=np.int64).reshape(-1, 2)
            _, starts, stops = united(np.zeros(len(rows), dtype=np.int64), rows[:, 0], rows[:, 1])
            own = list(zip(starts.tolist(), stops.tolist()))
            edges = [0, *[x for span in own for x in span], len(text)]
            kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
            sizes.append(len(text))
            spans.append([{"start": a, "stop": b} for a, b in own])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        columns = [part.column("doc_id").combine_chunks(), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])


def _batches(docs: DataFrame, batches: int) -> list[Column]:
    """Conditions that deal rows to batches of about as many, ascending by ``doc``."""
    shares = [k / batches for k in range(1, batches)]
    edges = sorted(set(docs.agg(F.percentile_approx("doc", shares, 1000)).first()[0] or []))
    if not edges:
        return [F.lit(True)]
    doc = F.col("doc")
    return [doc <= edges[0], *[(doc > a) & (doc <= b) for a, b in zip(edges, edges[1:])], doc > edges[-1]]


def repeated_spans(docs: DataFrame, batches: int = BATCHES, array_bytes: int = ARRAY_BYTES, together: int = TOGETHER) -> DataFrame:
    """(doc, at, n) of bytes that repeat in documents (doc, text as bytes), in any order, perhaps overlapping."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    family = Family(scratch, array_bytes)
    conditions = _batches(docs, batches)
    for condition in conditions:
        family.add(docs.filter(condition), condition is conditions[-1])
    found = family.results()
    gone = found.filter(F.col("what") == GONE).select("doc", "at", "n")
    return gone.unionByName(compared(docs, found.filter(F.col("what") == ASKED), scratch, together))


def remove_repeats(docs: DataFrame, batches: int = BATCHES, array_bytes: int = ARRAY_BYTES, together: int = TOGETHER) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: bytes covered by a MATCH-byte string that also starts earlier go.

    Earlier means in a document of smaller id, or in the same document further to the front; spans are maximal, and
    ``kept`` is what is left, which may begin or end inside a character. Null and empty texts have no bytes. Ids are
    whole numbers; a null id counts as one id below all others. Rows that repeat an id share its spans: what must go
    in one of them goes at the same place in all, and equal rows get equal results. An empty table gives no row. Only
    ``doc_id`` and ``text`` are read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("binary").alias("text"))
    gone = repeated_spans(rows.select("doc", "text"), batches, array_bytes, together)
    by_doc = gone.groupBy("doc").agg(F.collect_set(F.struct("at", "n")).alias("found"))  # no more than the text is long
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.join(by_doc, "doc", "left").mapInArrow(_cut, f"doc_id {kind}, n_bytes long, spans {SPANS_DDL}, kept binary")


@query("op11_repeated_bytes")
def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document's text repeats, and a digest of the rest."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
