"""Exact Jaccard join of documents by their sets of word shingles, with skipping by set relations.

Documents of equal sets are one set from here on. Tokens are ordered by a count sketch of fixed size, rarest first,
and each set enters the index lists of its prefix only. Index level: lists are sorted by set size and read in
blocks, and a pair of blocks is skipped where sizes or positions rule every pair out. Answer level: sets
that share the lead of most of their lists stream by a few leaders; a set that links to a leader is kept as the few
tokens by which they differ, and its further answers come from the leader's overlaps, corrected by those tokens.
Sets of different groups that stand close to each other in the lists are compared next, a fixed number for each entry.
Then every pair that is not yet connected becomes a candidate, so a group of near copies costs a bounded number of
comparisons for each of its members, but for sets that may link to some member and have not been found to; such a set
meets a large group as a whole, once for each list. No link between different groups is lost. Full sets are made again
from the texts that need them, found through a bit map of fixed size, and never for all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quirelens.llm.common import Scratch, bytes_of, holds, key_bits, query, sized_batches, table, unused

SHINGLE = 4
PERCENT = 85  # links need 100 * intersection >= PERCENT * union
SKETCH_LOG2 = 22
SKETCH_BLOCK = 1 << 12
BATCH_BYTES = 4 << 20
BLOCK = 256  # entries of an index list compared at a time
LEADS = 8  # sets of different sizes that lead in one list; what fits none has no leader there
EARLY_PARTNERS = (2, 24)  # likeliest pairs of each set that are compared first, by round
NEAREST = 4  # next entries of a list with which an entry makes early pairs
ORDERS = 8  # hashed orders in which the entries of lists stand then
PART_BYTES = 128 << 10  # of prefixes of one label that are met at a time
MOST_MEMBERS = 32  # labels of more sets are met as a whole by the sets of other labels
MOST_LEADERS = 64  # held while a group streams by
GROUP_PART = 2000  # larger groups stream by in parts
BITMAP = 512  # bits of a set's parity map
LIST_PART = 4096  # longer lists are compared in parts, by several tasks
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a shorter text is one shingle, an empty one none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=len(words))], dtype=np.uint64)
    made = h[: len(h) - SHINGLE + 1]
    for k in range(1, SHINGLE):
        made = ((made ^ (made >> np.uint64(32))) * MIX) ^ (made << np.uint64(7)) ^ h[k:len(h) - SHINGLE + 1 + k]
    made = (made ^ (made >> np.uint64(29))) * MIX
    return np.unique(made ^ (made >> np.uint64(32)))


def least_overlap(a, b):
    """Smallest intersection with which sets of these sizes link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_size(n):
    """Tokens of which two linked sets, each in one common order, share at least one."""
    return n - -(-PERCENT * n // 100) + 1


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_LOG2)).astype(np.int64)


def token_levels(docs: DataFrame) -> np.ndarray:
    """For each slot of the sketch a level that grows with the number of documents whose tokens fall there.

    Each task adds up its own sketch; blocks of slots are then added as they stream by. The result is a byte a slot.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_LOG2, dtype=np.int32)
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            sets = [_slots(shingles(t)) for t in bytes_of(rows.column("text"))]
            total += np.bincount(np.concatenate(sets), minlength=len(total))
        parts = [(k, total[k * SKETCH_BLOCK:(k + 1) * SKETCH_BLOCK]) for k in range(len(total) // SKETCH_BLOCK)]
        parts = [(k, zlib.compress(p.astype("<i8").tobytes(), 1)) for k, p in parts if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["block", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for k, packed in zip(rows.column("block").to_pylist(), rows.column("counts").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(packed), dtype="<i8")
        levels = {k: np.floor(4 * np.log2(1 + v)).astype(np.uint8).tobytes() for k, v in sums.items()}
        yield pa.RecordBatch.from_arrays([pa.array(list(levels), pa.int32()), pa.array(list(levels.values()), pa.binary())], ["block", "levels"])

    counted = docs.select("text").mapInArrow(add, "block int, counts binary").repartition("block")
    found = np.zeros(1 << SKETCH_LOG2, dtype=np.uint8)
    for row in counted.mapInArrow(merge, "block int, levels binary").collect():  # a byte a slot in all
        found[row.block * SKETCH_BLOCK:(row.block + 1) * SKETCH_BLOCK] = np.frombuffer(row.levels, dtype=np.uint8)
    return found


def parity(tokens: np.ndarray) -> bytes:
    """For each of BITMAP slots whether an odd number of the set's tokens falls there.

    The maps of two sets differ in no more bits than the sets in tokens, which bounds their overlap from above.
    """
    slots = ((tokens >> np.uint64(20)) & np.uint64(BITMAP - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=BITMAP) & 1).astype(np.uint8)).tobytes()


def signature(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def describe(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """(doc_id, text_key, n, sig, prefix, bits) of every row: a hash of the text, and size, 128-bit signature, rarest tokens and parity map of its set; null signature for an empty set."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # 2**SKETCH_LOG2 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sized_batches(batches, "text", BATCH_BYTES):
            sizes, sigs, prefixes, bits = [], [], [], []
            for text in bytes_of(rows.column("text")):
                s = shingles(text)
                sizes.append(len(s))
                sigs.append(signature(s) if len(s) else None)
                first = s[np.argsort(sent.value[_slots(s)], kind="stable")][: prefix_size(len(s))] if len(s) else s
                prefixes.append(first.tobytes())
                bits.append(parity(s))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").combine_chunks(), rows.column("text_key").combine_chunks(),
                    pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(prefixes, pa.binary()), pa.array(bits, pa.binary()),
                ],
                ["doc_id", "text_key", "n", "sig", "prefix", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, n long, sig binary, prefix binary, bits binary")


def postings(sets: DataFrame) -> DataFrame:
    """(token, eid, n, pos): the index entries of every set's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            prefixes = rows.column("prefix").to_pylist()
            tokens = np.frombuffer(b"".join(prefixes), dtype="<i8")
            sizes = np.array([len(p) // 8 for p in prefixes], dtype=np.int64)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            eid, n = (np.repeat(np.asarray(rows.column(c)), sizes) for c in ("eid", "n"))
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(eid), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32))], ["token", "eid", "n", "pos"])

    return sets.select("eid", "n", "prefix").mapInArrow(run, "token long, eid long, n int, pos int")


def index_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists with two or more sets, each with a ``lead`` of about its size, itself if there is none.

    The lead is the set whose hash is least, so near copies, which share most of their lists, have one lead in most of
    them. Only the leads of the last list are kept between batches.
    """
    names = ["token", "eid", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last row so far, which may be alone in its list
        last_token, leads = None, []

        def emit(columns: list[np.ndarray], before: bool, after: bool) -> pa.RecordBatch:
            nonlocal last_token, leads
            token = columns[0]
            same = token[1:] == token[:-1]
            keep = np.concatenate(([before], same)) | np.concatenate((same, [after]))
            token, eid, n, pos = (c[keep] for c in columns)
            lead, lead_n = eid.copy(), n.copy()
            starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, dtype=np.int64)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(token)]):
                if last_token != token[s]:
                    last_token, leads = token[s], []
                open_, k = np.arange(s, e), 0
                while len(open_) and k < LEADS:
                    if k == len(leads):
                        leads.append((int(eid[open_[0]]), int(n[open_[0]])))
                    at, size = leads[k]
                    own = n[open_].astype(np.int64)
                    fits = (100 * np.minimum(own, size) >= PERCENT * np.maximum(own, size))
                    lead[open_[fits]], lead_n[open_[fits]] = at, size
                    open_, k = open_[~fits], k + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in (token, eid, n, pos, lead, lead_n)], [*names, "lead", "lead_n"])

        before = False
        for rows in batches:
            if not rows.num_rows:
                continue
            columns = [np.asarray(rows.column(c)) for c in names]
            if held is not None:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns)]
            body = [c[:-1] for c in columns]
            if len(body[0]):
                after = bool(columns[0][-2] == columns[0][-1])
                yield emit(body, before, after)
                before = after
            held = [c[-1:] for c in columns]
        if held is not None and before:
            yield emit(held, before, False)

    ordered = entries.repartition("token").sortWithinPartitions("token", F.xxhash64("eid"), "eid")
    return ordered.mapInArrow(run, "token long, eid long, n int, pos int, lead long, lead_n int")


def _needed(a: Column, b: Column) -> Column:
    """Common prefix tokens without which sets of sizes a and b cannot link."""
    most = F.greatest(a, b)
    return F.ceil(PERCENT * (a + b) / (100 + PERCENT)) - F.ceil(PERCENT * most / 100) + 1


def fetch_sets(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(eid, tokens) of the wanted sets, made again from the text of one document of each."""
    wanted = sets.join(wanted, "eid", "left_semi").select("eid", "sig", "rep")
    bits = docs.sparkSession.sparkContext.broadcast(key_bits(wanted, _key(F.col("rep"))))  # at most a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            some = np.flatnonzero(holds(bits.value, np.asarray(rows.column("key"))))
            picked = rows.take(pa.array(some))
            for part in sized_batches(iter([picked]), "text", BATCH_BYTES):
                found = [shingles(t) for t in bytes_of(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").combine_chunks(), pa.array([signature(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                    ["doc_id", "sig", "tokens"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", _key(F.col("doc_id")).alias("key"), "text").mapInArrow(run, f"doc_id {kind}, sig binary, tokens binary")
    named = wanted.withColumnRenamed("sig", "_sig")
    return read.join(named, (F.col("sig") == F.col("_sig")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("eid", "tokens")


def _key(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(1 << 40))


def _tokens(packed: bytes | None) -> np.ndarray:
    return np.frombuffer(packed or b"", dtype="<u8")


def _inside(some: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Which of some tokens are in a sorted set."""
    if not len(tokens):
        return np.zeros(len(some), dtype=bool)
    at = np.minimum(np.searchsorted(tokens, some), len(tokens) - 1)
    return tokens[at] == some


def near_sets(members: DataFrame, full: DataFrame) -> DataFrame:
    """(eid, lead, gone, new) of links between sets of one group: the leader's tokens the set lacks, and its own that the leader lacks.

    Members of a (``g``, ``part``) stream by in order of ``rank``. Each is compared with the group's leaders so far and
    linked to all it can; one that links to none becomes a leader while there is room. Rows of leaders have themselves
    as ``lead``. What is left open here is settled later, so the bound on leaders costs no link.
    """
    names = ["g", "part", "eid", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leaders = None, []
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        for rows in batches:
            out: list[list] = [[], [], [], []]
            for g, part, eid, packed in zip(*(rows.column(c).to_pylist() for c in names)):
                if group != (g, part):
                    group, leaders = (g, part), []
                own, alone = _tokens(packed), True
                for lead, other in leaders:
                    if PERCENT * max(len(own), len(other)) > 100 * min(len(own), len(other)):
                        continue
                    common = _inside(own, other)
                    if int(common.sum()) >= least_overlap(len(own), len(other)):
                        alone = False
                        for c, v in zip(out, (eid, lead, other[~_inside(other, own)].tobytes(), own[~common].tobytes())):
                            c.append(v)
                if alone and len(leaders) < MOST_LEADERS:
                    leaders.append((eid, own))
                    for c, v in zip(out, (eid, eid, b"", b"")):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["eid", "lead", "gone", "new"])

    joined = members.join(full, "eid").repartition("g", "part").sortWithinPartitions("g", "part", "rank", "eid")
    return joined.select(*names).mapInArrow(run, "eid long, lead long, gone binary, new binary")


def contract(first: DataFrame, full: DataFrame, scratch: Scratch) -> DataFrame:
    """Links inside the groups that share a lead, large groups in parts, and then between the leaders of their parts."""
    leads = first.select("lead").distinct()
    members = first.select(F.col("lead").alias("g"), "eid", F.lit(1).alias("rank")).union(
        leads.select(F.col("lead").alias("g"), F.col("lead").alias("eid"), F.lit(0).alias("rank"))
    )
    sizes = members.groupBy("g").agg(F.ceil(F.count("*") / GROUP_PART).alias("parts"))
    members = members.join(sizes, "g").withColumn("part", F.pmod(F.xxhash64("eid"), F.col("parts")))
    links = scratch.write(near_sets(members.select("g", "part", "eid", "rank"), full), "links")
    heads = links.filter("eid = lead").select("eid").join(members.filter("parts > 1").select("g", "eid", "rank"), "eid")
    between = near_sets(heads.select("g", F.lit(0).cast("bigint").alias("part"), "eid", "rank"), full)
    return links.filter("eid != lead").unionByName(scratch.write(between.filter("eid != lead"), "between"))


def mixed_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, parts, eid, n, pos, label, members): the entries of lists that hold sets of two or more labels, the number
    of parts each list is compared in, and the number of sets under each label."""
    sized = labels.join(labels.groupBy("label").agg(F.count("*").alias("members")), "label")
    named = lists.select("token", "eid", "n", "pos").join(sized, "eid", "left")
    named = named.withColumn("label", F.coalesce("label", "eid")).withColumn("members", F.coalesce("members", F.lit(1)))
    mixed = named.groupBy("token").agg(F.count("*").alias("m"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = mixed.filter("low != high").select("token", F.ceil(F.col("m") / LIST_PART).cast("int").alias("parts"))
    return named.join(mixed, "token")


def neighbours(lists: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    """(a, b): pairs of sets under different labels that stand close to each other in index lists, each in one of ORDERS
    hashed orders of sets. Each entry makes at most NEAREST pairs, however long its list is."""
    names = ["token", "part", "band", "label", "eid", "n", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last entries, whose neighbours may follow
        for rows in batches:
            columns = [np.asarray(rows.column(c)) for c in names]
            old = 0
            if held is not None:
                old, columns = len(held[0]), [np.concatenate((h, c)) for h, c in zip(held, columns)]
            token, part, band, label, eid, n, pos = columns
            found = []
            for d in range(1, NEAREST + 1):
                x, y = slice(0, max(len(eid) - d, 0)), slice(d, None)
                ok = (token[x] == token[y]) & (part[x] == part[y]) & (band[x] == band[y]) & (label[x] != label[y])
                ok &= np.arange(d, d + len(ok)) >= old
                i = np.flatnonzero(ok)
                j = i + d
                small, large = np.minimum(n[i], n[j]).astype(np.int64), np.maximum(n[i], n[j]).astype(np.int64)
                reach = np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i], n[j] - pos[j])
                fits = (100 * small >= PERCENT * large) & (reach >= least_overlap(small, large))
                i, j = i[fits], j[fits]
                found.append(np.stack((np.minimum(eid[i], eid[j]), np.maximum(eid[i], eid[j])), axis=1))
            pairs = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
            held = [c[-NEAREST:] for c in columns]

    entries = mixed_lists(lists, labels).withColumn("part", F.pmod(F.xxhash64("eid"), F.col("parts")).cast("int"))
    place = F.xxhash64("eid", F.pmod("token", F.lit(ORDERS)), F.lit(seed))
    entries = entries.withColumn("band", F.floor(F.log("n") / -np.log(PERCENT / 100)).cast("int"))
    ordered = entries.select(*names).repartition("token", "part").sortWithinPartitions("token", "part", "band", place, "eid")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def candidates(lists: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(whole, a, b, common): pairs of sets under different labels that share enough prefix tokens to link.

    A pair whose parity maps differ in more bits than linked sets can is left out where it is met.

    Where a label has more than MOST_MEMBERS sets, a pair with one of them becomes a row (set, label) with ``whole``
    true: the set may link to some member of the label. It is made once for a list, not once for every member there.
    """
    named = mixed_lists(lists, labels).withColumn("part", F.pmod(F.xxhash64("eid"), F.col("parts")).cast("int"))
    named = named.join(sets.select("eid", "bits"), "eid")
    cells = named.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select(
        "token", F.least("part", "other").alias("c1"), F.greatest("part", "other").alias("c2"), "part", "eid", "n", "pos", "label", "members", "bits"
    )

    def pairs_of(g: list[np.ndarray], crossing: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        part, eid, n, pos, label, _, bits = g
        for i in range(0, len(eid), BLOCK):
            for j in range(i, len(eid), BLOCK):
                a, b = slice(i, i + BLOCK), slice(j, j + BLOCK)
                if 100 * int(n[a][-1]) < PERCENT * int(n[b][0]):
                    break  # sorted by size: no later block can link either
                small, large = n[a][:, None].astype(np.int64), n[b][None, :].astype(np.int64)
                behind = np.minimum(small - pos[a][:, None], large - pos[b][None, :])
                ahead = np.minimum(pos[a][:, None], pos[b][None, :])
                ok = (100 * small >= PERCENT * large) & (label[a][:, None] != label[b][None, :])
                ok &= ahead + behind >= least_overlap(small, large)
                if i == j:
                    ok &= np.arange(ok.shape[0])[:, None] < np.arange(ok.shape[1])[None, :]
                if crossing:
                    ok &= part[a][:, None] != part[b][None, :]
                x, y = np.nonzero(ok)
                x, y = x + i, y + j
                differ = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
                fits = n[x].astype(np.int64) + n[y] - differ >= 2 * least_overlap(n[x].astype(np.int64), n[y].astype(np.int64))
                if fits.any():
                    yield x[fits], y[fits]

    def whole_of(parts: list[np.ndarray]) -> np.ndarray:
        """One row of each (set, label) with the least and greatest size met; rows are set, label, own size, least, greatest."""
        rows = np.concatenate(parts, axis=1)
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        starts = np.flatnonzero(np.concatenate(([True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1]))))
        return np.stack((*rows[:3, starts], np.minimum.reduceat(rows[3], starts), np.maximum.reduceat(rows[4], starts)))

    names = ["whole", "a", "b", "n_a", "n_b", "n_most", "pos_a", "pos_b"]

    def batch(whole: bool, *found: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), whole)), *(pa.array(c.astype(np.int64)) for c in found)], names)

    def cell(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        _, eid, n, pos, label, members, _ = g = columns[3:]
        met: list[np.ndarray] = []
        for x, y in pairs_of(g, bool(columns[1][0] != columns[2][0])):
            large = np.maximum(members[x], members[y]) > MOST_MEMBERS
            if large.any():
                u, v = x[large], y[large]
                swap = (members[u] > members[v]) | ((members[u] == members[v]) & (label[u] > label[v]))
                u, v = np.where(swap, v, u), np.where(swap, u, v)  # v's label has more sets
                met.append(whole_of([np.stack((eid[u], label[v], n[u], n[v], n[v])).astype(np.int64)]))
                x, y = x[~large], y[~large]
            if len(x):
                swap = eid[x] > eid[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                yield batch(False, eid[x], eid[y], n[x], n[y], n[y], pos[x], pos[y])
        if met:
            found = whole_of(met)
            none = np.zeros(found.shape[1], dtype=np.int64)
            yield batch(True, *found, none, none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for rows in batches:
            if not rows.num_rows:
                continue
            columns = [np.asarray(c) for c in rows.columns[:-1]]
            columns.append(np.frombuffer(b"".join(rows.columns[-1].to_pylist()), dtype=np.uint64).reshape(rows.num_rows, -1))
            if held is not None:
                columns = [np.concatenate((h, c)) for h, c in zip(held, columns)]
            change = np.zeros(len(columns[0]) - 1, dtype=bool)
            for c in columns[:3]:
                change |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for s, e in zip(starts, starts[1:]):
                yield from cell([c[s:e] for c in columns])
            held = [c[starts[-1]:] for c in columns]  # at most two parts of a list
        if held is not None:
            yield from cell(held)

    ordered = cells.repartition("token", "c1", "c2").sortWithinPartitions("token", "c1", "c2", "n", "eid")
    found = ordered.mapInArrow(run, "whole boolean, a long, b long, n_a long, n_b long, n_most long, pos_a long, pos_b long")
    pairs = found.groupBy("whole", "a", "b").agg(
        F.first("n_a").alias("n_a"), F.min("n_b").alias("n_b"), F.max("n_most").alias("n_most"), F.count("*").alias("common"),
        F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b"),
    )
    rest = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
    enough = F.ceil(PERCENT * (F.col("n_a") + F.col("n_b")) / (100 + PERCENT))
    pair = (F.col("common") >= _needed(F.col("n_a"), F.col("n_b"))) & (F.col("common") + rest >= enough)
    # of all sizes met, the least or the greatest needs fewest common tokens, but for one by rounding
    some = F.col("common") >= F.least(_needed(F.col("n_a"), F.col("n_b")), _needed(F.col("n_a"), F.col("n_most"))) - 1
    return pairs.filter(F.when(F.col("whole"), some).otherwise(pair)).select("whole", "a", "b", "common")


def sharing(rows: DataFrame) -> DataFrame:
    """(a, b, common) of sets and those of their ``members`` that share enough prefix tokens to link, from rows (a, n_a, prefix_a, members)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out: list[np.ndarray] = []
            for i, (a, n, prefix) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("a", "n_a", "prefix_a")))):
                members = rows.column("members")[i].values
                packed = members.field("prefix").to_pylist()
                lengths = np.array([len(p) // 8 for p in packed])
                inside = _inside(_tokens(b"".join(packed)), np.sort(_tokens(prefix)))
                common = np.add.reduceat(inside.astype(np.int64), np.cumsum(lengths) - lengths)
                sizes = np.asarray(members.field("n"))
                small, large = np.minimum(sizes, n), np.maximum(sizes, n)
                needed = least_overlap(small, large) - -(-PERCENT * large // 100) + 1
                fits = (100 * small >= PERCENT * large) & (common >= needed) & (common > 0)
                out.append(np.stack((np.full(int(fits.sum()), a), np.asarray(members.field("eid"))[fits], common[fits])))
            found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["a", "b", "common"])

    return rows.select("a", "n_a", "prefix_a", "members").mapInArrow(run, "a long, b long, common long")


def _named_a(sets: DataFrame) -> DataFrame:
    return sets.select(F.col("eid").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("prefix_a"))


def likeliest(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, rank) of the pairs that share enough prefix tokens, the set's pair with most of them first."""
    other = sets.select(F.col("eid").alias("b"), F.array(F.struct("eid", "n", "prefix")).alias("members"))
    found = sharing(pairs.select("a", "b").join(_named_a(sets), "a").join(other, "b"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.col("common").desc(), "b"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= EARLY_PARTNERS[-1]).select("a", "b", "rank")


def pairs_with_members(found: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of candidates, where a whole label stands for those of its sets that share enough prefix tokens.

    The sets of a label are gathered in parts of about PART_BYTES, so their number bounds nothing.
    """
    whole = found.filter("whole").select("a", F.col("b").alias("label"))
    members = labels.join(whole.select("label").distinct(), "label", "left_semi").join(sets.select("eid", "n", "prefix"), "eid")
    parts = members.groupBy("label").agg(F.ceil(F.sum(F.octet_length("prefix")) / PART_BYTES).alias("parts"))
    members = members.join(parts, "label").withColumn("part", F.pmod(F.xxhash64("eid"), F.col("parts")))
    members = members.groupBy("label", "part").agg(F.collect_list(F.struct("eid", "n", "prefix")).alias("members"))
    met = sharing(whole.join(_named_a(sets), "a").join(members, "label"))
    return found.filter(~F.col("whole")).select("a", "b").unionByName(met.select("a", "b"))


def relabel(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose sets are under different labels, with ``label_a`` and ``label_b``."""
    for side in ("a", "b"):
        own = labels.select(F.col("eid").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.drop(f"label_{side}").join(own, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    return pairs.filter("label_a != label_b")


def compare_through_leaders(pairs: DataFrame, near: DataFrame, full: DataFrame) -> DataFrame:
    """(a, b, label_a, label_b) of the pairs that link. The overlap of two leaders is found once and corrected for each pair of their sets."""
    for side in ("a", "b"):
        own = near.select(
            F.col("eid").alias(side), F.col("lead").alias(f"lead_{side}"), F.col("gone").alias(f"gone_{side}"), F.col("new").alias(f"new_{side}")
        )
        pairs = pairs.join(own, side, "left").withColumn(f"lead_{side}", F.coalesce(f"lead_{side}", side))
    for side in ("a", "b"):
        pairs = pairs.join(full.select(F.col("eid").alias(f"lead_{side}"), F.col("tokens").alias(f"tokens_{side}")), f"lead_{side}")
    names = ["label_a", "label_b", "a", "b", "lead_a", "lead_b", "gone_a", "new_a", "gone_b", "new_b", "tokens_a", "tokens_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple | None = None
        s = t = np.zeros(0, dtype=np.uint64)
        base = 0
        for rows in batches:
            out: list[list[int]] = [[], [], [], []]
            for label_a, label_b, a, b, lead_a, lead_b, *packed in zip(*(rows.column(c).to_pylist() for c in names)):
                gone_a, new_a, gone_b, new_b = (_tokens(p) for p in packed[:4])
                if seen != (lead_a, lead_b):
                    seen, s, t = (lead_a, lead_b), _tokens(packed[4]), _tokens(packed[5])
                    base = int(_inside(s, t).sum())
                overlap = base - int(_inside(gone_a, t).sum()) + int(_inside(new_a, t).sum())  # of a with b's leader

                def in_a(some: np.ndarray) -> int:
                    return int(((_inside(some, s) & ~_inside(some, gone_a)) | _inside(some, new_a)).sum())

                overlap += in_a(new_b) - in_a(gone_b)
                if overlap >= least_overlap(len(s) - len(gone_a) + len(new_a), len(t) - len(gone_b) + len(new_b)):
                    for c, v in zip(out, (a, b, label_a, label_b)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b", "label_a", "label_b"])

    return pairs.select(*names).sortWithinPartitions("lead_a", "lead_b").mapInArrow(run, "a long, b long, label_a long, label_b long")


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """(node, root) for every node of the edges. Each round joins every root to the neighbour whose hash is least, and
    keeps the edges that then lead between different roots; a new hash each round keeps chains from being slow."""
    edges = scratch.write(edges.select("a", "b").filter("a != b").distinct(), f"{tag}-edges0")
    ends = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    roots = scratch.write(ends.select("node", F.col("node").alias("root")), f"{tag}-roots0")
    k = 0
    while not edges.isEmpty():
        k += 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("id"))
        least = both.groupBy("a").agg(F.min(order("b")).alias("m")).select("a", F.least("m", order("a"))["id"].alias("to"))
        least = scratch.write(least, f"{tag}-least{k}")
        moved = roots.join(least.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        new_roots = scratch.write(moved, f"{tag}-roots{k}")
        moved = edges.join(least.withColumnRenamed("to", "x"), "a").join(least.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        moved = moved.filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        new_edges = scratch.write(moved, f"{tag}-edges{k}")
        for name in (f"edges{k - 1}", f"roots{k - 1}", f"{tag}-least{k}"):
            scratch.drop(name)
        edges, roots = new_edges, new_roots
    return roots


def linked_rows(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, n, root, component_id) of every row; ``root`` names its component, null for an empty set."""
    rows = scratch.write(describe(docs, token_levels(docs)), "rows")
    grouped = rows.filter(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    sets = scratch.write(grouped.withColumn("eid", F.monotonically_increasing_id()), "sets")
    lists = scratch.write(index_lists(postings(sets)), "lists")

    led = lists.filter("lead != eid").groupBy("eid", "lead").agg(F.count("*").alias("common"), F.first("n").alias("n"), F.first("lead_n").alias("lead_n"))
    led = led.filter(F.col("common") >= _needed(F.col("n"), F.col("lead_n")))
    best = led.groupBy("eid").agg(F.max(F.struct("common", (-F.col("lead")).alias("lead")))["lead"].alias("lead"))
    first = scratch.write(best.select("eid", (-F.col("lead")).alias("lead")), "first")
    wanted = first.select("eid").union(first.select(F.col("lead").alias("eid"))).distinct()
    full = scratch.write(fetch_sets(docs, sets, wanted), "first_sets")
    links = contract(first, full, scratch)
    scratch.drop("first_sets")
    # one leader for each set; a leader stays its own
    near = links.groupBy("eid").agg(F.min(F.struct("lead", "gone", "new")).alias("x")).select("eid", "x.*")
    near = scratch.write(near.join(links.select(F.col("lead").alias("eid")).distinct(), "eid", "left_anti"), "near")
    joined = components(links.select(F.col("eid").alias("a"), F.col("lead").alias("b")), scratch, "near")
    joined = scratch.write(joined.select(F.col("node").alias("eid"), F.col("root").alias("label")), "joined")

    def compare(pairs: DataFrame, labels: DataFrame, full: DataFrame, tag: str) -> DataFrame:
        """The labels after the links among the pairs."""
        found = scratch.write(compare_through_leaders(pairs, near, full), f"found-{tag}")
        tops = components(found.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")), scratch, f"far-{tag}")
        moved = labels.join(tops.withColumnRenamed("node", "label").withColumnRenamed("root", "top"), "label", "full_outer")
        return scratch.write(moved.select(F.coalesce("eid", "label").alias("eid"), F.coalesce("top", "label").alias("label")), f"joined-{tag}")

    def sets_of(pairs: DataFrame, tag: str) -> DataFrame:
        """Full sets of what leads the sets of the pairs."""
        ends = pairs.select(F.col("a").alias("eid")).union(pairs.select(F.col("b").alias("eid"))).distinct()
        leads = ends.join(near.select("eid", "lead"), "eid", "left").select(F.coalesce("lead", "eid").alias("eid")).distinct()
        return scratch.write(fetch_sets(docs, sets, leads), tag)

    # close entries of the lists first, the likeliest pairs of each set before others: the links found join most labels,
    # and pairs under one label need no comparing
    for seed, most in enumerate(EARLY_PARTNERS):
        close = scratch.write(likeliest(neighbours(lists, joined, seed), sets), f"close{seed}")
        full = sets_of(close, f"close_sets{seed}")
        for rank in sorted({EARLY_PARTNERS[0], most}):
            joined = compare(relabel(close.filter(F.col("rank") <= rank), joined), joined, full, f"early{seed}-{rank}")
        scratch.drop(f"close_sets{seed}")
    # then all pairs of which no link is known yet
    found = scratch.write(candidates(lists, joined, sets), "candidates")
    scratch.drop("lists")
    more = scratch.write(relabel(pairs_with_members(found, joined, sets), joined), "more")
    joined = compare(more, joined, sets_of(more, "more_sets"), "last")
    scratch.drop("more_sets")

    known = sets.select("eid", "sig", "rep").join(joined, "eid", "left").withColumn("root", F.coalesce("label", "eid"))
    least = known.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = scratch.write(known.join(least, "root").select("sig", "root", "component_id"), "components")
    own = rows.select("doc_id", "text_key", "n", "sig").join(named, "sig", "left")
    return own.select("doc_id", "text_key", "n", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: its set's size and the smallest id it reaches by links.

    A null or empty text has an empty set and is alone. A row without an id takes the component of rows it links to,
    null if none has an id. Repeated rows are linked like any copies; an empty table gives no rows. Only ``doc_id``
    and ``text`` are read, whatever other columns there are.
    """
    rows = linked_rows(docs, Scratch(docs.sparkSession, "jaccard"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each component, that of the smallest id (then text hash); rows with empty sets all stay.

    Rows are told apart by id and text hash; the rows to leave out are joined as a written table, so its size decides
    how. Where a staying row is repeated as it is, one of its copies stays. Columns may have any names, and all stay;
    an empty table stays empty.
    """
    id_, key = unused(docs, "_id", "_key")
    scratch = Scratch(docs.sparkSession, "keep-one")
    rows = scratch.write(linked_rows(docs, scratch).filter(F.col("root").isNotNull()).select("root", "doc_id", "text_key"), "linked")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("w"))
    judged = rows.join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("text_key") == F.col("w.text_key"))
    gone = scratch.write(judged.filter(~stays).select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct(), "gone")
    counted = judged.filter(stays).groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter("n > 1")
    twice = scratch.write(counted.select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)), "twice")
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(key))
    kept = docs.join(gone, same, "left_anti")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, same, "left_semi").withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)
    return kept.join(twice, same, "left_anti").unionByName(once)


@query("op7_jaccard_join")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of PERCENT percent Jaccard similarity."""
    return link_documents(table(spark, sf_dir, "documents"))
