"""Benchmark decontamination with an FM-index for each shard of training texts.

A shard is a few megabytes of a partition's documents as one sequence of word numbers; words of no phrase, and runs
too short for any, are breaks. Its suffixes are sorted, the transform is kept as a wavelet tree with ranks, and some
suffix positions are kept. All phrases are searched backwards side by side; each range of rows found is turned into
positions by stepping to the next kept one. The covered words of a document are merged into spans. Documents are
never shuffled: the phrases, read in blocks of bounded size, go to them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import Scratch, bytes_of, query, sized_batches, table

WINDOW = 10
SHARD_BYTES = 4 << 20
KEPT_EVERY = 16  # of the text positions whose suffix positions are kept
OCCURRENCES = 1 << 20  # located at a time
BLOCK_WORDS = 2_000_000  # benchmark words in one broadcast block
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 text."""
    return text.translate(FOLD).split()


@dataclass
class Phrases:
    """The windows of a block of benchmark items as padded word numbers, with the items each belongs to."""

    vocabulary: dict[bytes, int]
    words: np.ndarray  # windows x WINDOW, 0 behind the end
    sizes: np.ndarray
    items: list[list[str]]  # by window

    @property
    def shortest(self) -> int:
        return int(self.sizes.min()) if len(self.sizes) else 0


def phrases_of(items: list[tuple[str, bytes]]) -> Phrases:
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for name, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        for start in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
            found.setdefault(tuple(ids[start:start + WINDOW]), set()).add(name)
    windows = list(found)
    words = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for i, w in enumerate(windows):
        words[i, : len(w)] = w
    return Phrases(vocabulary, words, np.array([len(w) for w in windows], dtype=np.int64), [sorted(found[w]) for w in windows])


class WaveletTree:
    """Ranks of symbols in a sequence: one level of bits for each bit of the alphabet, ones behind zeros below."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            ones = (sequence >> b) & 1
            upto = np.concatenate(([0], np.cumsum(ones))).astype(np.int32)
            zeros = len(sequence) - int(upto[-1])
            self.levels.append((b, upto, zeros))
            sequence = np.concatenate([sequence[ones == 0], sequence[ones == 1]])

    def ranks(self, symbols: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For each place, how many of the symbol come before it."""
        low, ends = np.zeros(len(symbols), dtype=np.int64), [p.astype(np.int64) for p in places]
        for b, upto, zeros in self.levels:
            one = (symbols >> b) & 1 == 1
            low, *ends = (np.where(one, zeros + upto[x], x - upto[x]) for x in (low, *ends))
        return [e - low for e in ends]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; each break (0) is a symbol of its own, so no comparison runs past one."""
    n = len(symbols)
    breaks = np.flatnonzero(symbols == 0)
    key = symbols.astype(np.int64) + len(breaks)
    key[breaks] = np.arange(len(breaks))
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1

    def starts(sorted_key: np.ndarray, base: np.ndarray) -> np.ndarray:
        new = np.ones(len(sorted_key), dtype=bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        return base[np.maximum.accumulate(np.where(new, np.arange(len(sorted_key)), 0))]

    rank[order] = starts(key[order], np.arange(n))
    step = 1
    while True:
        sizes = np.bincount(rank[:n], minlength=n)
        at = np.flatnonzero(sizes[rank[order]] > 1)
        if not len(at):
            return order
        open_ = order[at]
        follow = rank[np.minimum(open_ + step, n)]
        pair = rank[open_] * (n + 2) + follow + 1
        own = np.argsort(pair, kind="stable")
        order[at] = open_[own]
        rank[open_[own]] = starts(pair[own], at)
        step *= 2


class FMIndex:
    """Search and location over one sequence of word numbers; 0 is a break."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_order(symbols)
        before = np.where(order > 0, symbols[np.maximum(order - 1, 0)], 0)
        self.last = before
        self.tree = WaveletTree(before, max(1, int(alphabet).bit_length()))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=alphabet + 1))))
        kept = (order % KEPT_EVERY == 0) | (before == 0)  # a step back never has to pass a break
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.positions = order[kept]

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all phrases, found from their last word to their first."""
        low = np.zeros(len(sizes), dtype=np.int64)
        high = np.full(len(sizes), len(self.last), dtype=np.int64)
        for k in range(words.shape[1]):
            on = np.flatnonzero((sizes > k) & (low < high))
            if not len(on):
                continue
            c = words[on, sizes[on] - 1 - k]
            a, b = self.tree.ranks(c, low[on], high[on])
            low[on], high[on] = self.first[c] + a, self.first[c] + b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to a kept position, plus their number."""
        rows, out = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        steps, on = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        while len(on):
            there = self.kept[rows[on]]
            done = on[there]
            out[done] = self.positions[self.kept_before[rows[done]]] + steps[done]
            on = on[~there]
            c = self.last[rows[on]]
            rows[on] = self.first[c] + self.tree.ranks(c, rows[on])[0]
            steps[on] += 1
        return out


def find(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """For each text of a shard: its number of words, the (first, end) word spans that phrases cover, and their items."""
    counts = np.zeros(len(texts), dtype=np.int64)
    spans = [np.zeros((0, 2), dtype=np.int64)] * len(texts)
    items: list[set[str]] = [set() for _ in texts]
    numbers, get = [], phrases.vocabulary.get
    for i, text in enumerate(texts):
        words = words_of(text)
        counts[i] = len(words)
        numbers.append(np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words)))
        numbers.append(np.zeros(1, dtype=np.int64))
    if not len(phrases.sizes) or not counts.any():
        return counts, spans, items
    whole = np.concatenate(numbers)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], whole > 0, [0])).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= phrases.shortest  # a shorter run holds no phrase
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return counts, spans, items
    lengths = ends - begins
    placed = np.cumsum(lengths + 1) - (lengths + 1)
    place = np.repeat(begins - placed, lengths + 1) + np.arange(int((lengths + 1).sum()))  # of each symbol in the shard
    symbols = np.where(np.isin(np.arange(len(place)), placed + lengths), 0, whole[np.minimum(place, len(whole) - 1)])
    index = FMIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.words, phrases.sizes)
    starts = np.concatenate(([0], np.cumsum(counts + 1)))  # a break behind each text
    cover = np.zeros(len(whole) + 1, dtype=np.int64)
    hit = np.flatnonzero(high > low)
    first = 0
    while first < len(hit):
        total = np.cumsum(high[hit[first:]] - low[hit[first:]])
        upto = first + max(1, int(np.searchsorted(total, OCCURRENCES, side="right")))
        part = hit[first:upto]
        many = high[part] - low[part]
        rows = np.repeat(low[part] - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(int(many.sum()))
        which = np.repeat(part, many)
        at = place[index.locate(rows)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + phrases.sizes[which], -1)
        text = np.searchsorted(starts, at, side="right") - 1
        for t, w in np.unique(np.stack([text, which], axis=1), axis=0).tolist():
            items[t].update(phrases.items[w])
        first = upto
    covered = np.cumsum(cover[:-1]) > 0
    for i in (i for i, found in enumerate(items) if found):
        own = covered[starts[i]:starts[i] + counts[i]]
        change = np.flatnonzero(np.diff(np.concatenate(([0], own, [0])).astype(np.int8)))
        spans[i] = change.reshape(-1, 2)
    return counts, spans, items


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching (first, end) spans as one each, in order."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate(([True], spans[1:, 0] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(spans) - 1]))
    return np.stack([spans[new, 0], reach[last]], axis=1)


def phrase_blocks(benchmark: DataFrame, words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark in blocks of at most about ``words`` words, one in memory at a time, the last perhaps empty; null texts have no windows."""
    held: list[tuple[str, bytes]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        text = (row.text or "").encode("utf-8", "surrogatepass")
        if held and size + len(text) // 2 > words:
            yield phrases_of(held)
            held, size = [], 0
        held.append((row.item_id or "", text))
        size += len(text) // 2
    yield phrases_of(held)


def search(docs: DataFrame, benchmark: DataFrame, *carried: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each row's ``n_words``, ``spans`` ((first, end) word numbers as 64-bit pairs, merged) and ``items``, with the carried columns.

    A pass for each block of the benchmark; the rows keep their partitions.
    """
    rows = docs.select(*dict.fromkeys([*carried, "text"]), *[F.lit(None).cast(t).alias(f"_{n}") for n, t in (("spans", "binary"), ("items", "array<string>"))])
    through = rows.columns
    made = _ddl(docs, through[:-2]) + "_spans binary, _items array<string>, _n_words long"
    for phrases in phrase_blocks(benchmark, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)  # at most about BLOCK_WORDS words and their windows
        rows = rows.mapInArrow(_search_pass(sent, through), made)
    return rows.select(*carried, F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def _ddl(docs: DataFrame, names: list[str]) -> str:
    return "".join(f"`{n}` {docs.schema[n].dataType.simpleString()}, " for n in names)


def _search_pass(sent, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value
        for shard in sized_batches(batches, "text", SHARD_BYTES):
            counts, spans, items = find(bytes_of(shard.column("text")), phrases)
            before, known = shard.column("_spans").to_pylist(), shard.column("_items").to_pylist()
            merged = [merge_spans(np.concatenate([np.frombuffer(b, dtype="<i8").reshape(-1, 2), s])) if b else s for b, s in zip(before, spans)]
            together = [sorted({*(k or ()), *i}) for k, i in zip(known, items)]
            columns = [shard.column(n).combine_chunks() for n in names[:-2]]
            columns += [
                pa.array([m.astype("<i8").tobytes() for m in merged], pa.binary()),
                pa.array(together, pa.list_(pa.string())), pa.array(counts),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names[:-2], "_spans", "_items", "_n_words"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document row: words, words hit, items found, their digest, and whether any word is hit.

    Null and empty texts have no words. Repeated rows are judged each for itself; items with one text all count. An
    empty benchmark hits nothing. Only ``doc_id``, ``text``, ``item_id`` are read.
    """
    found = search(docs, benchmark, "doc_id", block_words=block_words)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            spans = [np.frombuffer(b, dtype="<i8") for b in rows.column("spans").to_pylist()]
            hits = np.array([int((s[1::2] - s[::2]).sum()) for s in spans], dtype=np.int64)
            items = rows.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("n_words"), pa.array(hits), pa.array([len(i) for i in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]), pa.array(hits > 0),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.mapInArrow(digest, _ddl(docs, ["doc_id"]) + "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def cut_words(text: bytes, spans: np.ndarray) -> bytes:
    """The text without the words of the spans and what stands between them."""
    if not len(spans):
        return text
    places = [m.span() for m in WORD.finditer(text.translate(FOLD))]  # folding keeps every place
    out, at = [], 0
    for first, end in spans.tolist():
        out.append(text[at:places[first][0]])
        at = places[end - 1][1]
    out.append(text[at:])
    return b"".join(out)


def _cut_rows(length: str | None):
    """Rows with ``spans`` cut out of ``text``, ``changed`` where any were; changed ones without a word left go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in sized_batches(batches, "text", SHARD_BYTES):
            spans = [np.frombuffer(b, dtype="<i8").reshape(-1, 2) for b in shard.column("spans").to_pylist()]
            hit = [i for i, s in enumerate(spans) if len(s)]
            texts = bytes_of(shard.column("text"))
            made = {i: cut_words(texts[i], spans[i]) for i in hit}
            new = shard.column("text").to_pylist()
            for i, text in made.items():
                new[i] = text.decode("utf-8", "surrogatepass")
            names = [n for n in shard.column_names if n != "spans"]
            columns = {n: shard.column(n).combine_chunks() for n in names} | {"text": pa.array(new, pa.string())}
            if length:
                sizes = columns[length].to_pylist()
                for i in hit:
                    sizes[i] = len(new[i])
                columns[length] = pa.array(sizes, columns[length].type)
            changed = np.zeros(len(new), dtype=bool)
            changed[hit] = True
            stays = pa.array([i not in made or bool(words_of(made[i])) for i in range(len(new))], pa.bool_())
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(changed)], [*names, "changed"]).filter(stays)

    return run


def remove_passages(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with every occurrence of a benchmark window cut out of their text; other columns stay.

    A whole-number column ``n_chars`` gets the new length of a changed text. A document of which no word is left goes.

    All windows are found in a text before it is cut, whatever blocks the benchmark comes in. Words that come together
    by a cut can make a window again, so what was cut is searched again until nothing is found; each round takes words
    away, so it ends. Texts without a hit, null ones too, stay as they are.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    names = docs.columns
    own = ["text" if n == "text" else f"c{i}" for i, n in enumerate(names)]  # apart from the names used here
    rows = docs.toDF(*own)
    length = own[names.index("n_chars")] if "n_chars" in names and docs.schema["n_chars"].dataType.typeName() in ("long", "integer", "short", "byte") else None
    settled: list[DataFrame] = []
    k = 0
    while True:
        found = search(rows, benchmark, *own, block_words=block_words).select(*own, "spans")
        cut = scratch.write(found.mapInArrow(_cut_rows(length), _ddl(rows, own) + "changed boolean"), f"round{k}", "changed")
        settled.append(cut.filter(~F.col("changed")).drop("changed"))
        rows, k = cut.filter("changed").drop("changed"), k + 1
        if rows.isEmpty():
            break
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select(*own).toDF(*names)


@query("op5_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlap with the benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
