"""Spelling variants: words one edit apart, found by comparing blocks of words as padded code-point matrices.

Two words are one edit apart when their common prefix and common suffix together reach the longer length minus one.
One of the two must then reach half of that, so words are dealt by length and half, from the left and from the right,
and only blocks of words that share a half are compared, every word with every other at once. A half that very many
words share is cut into parts, and each pair of parts is a task's work of its own. A word's form is its most frequent
neighbour, where that is much more frequent; roots follow forms to their end by pointer jumping over written tables.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import Scratch, query, sized_batches, table

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5  # a form is at least so many times as frequent
TILE = 256  # words on a side of one comparison
GROUP_PART = 2048  # words of one half that are dealt together
MOST_COUNTED = 200_000  # different words a task counts before it hands them on
DAMAGE = 199  # the query deletes a letter where this divides a run's checksum
BATCH_BYTES = 4 << 20
PAD = 0xFFFFFFFF  # fills short rows of a matrix: no code point, as a word may hold any of those, zero too
# runs of [a-zÀ-ÿ] in UTF-8 after A-Z were lower-cased
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % LEAST_LETTERS)


def damaged(word: bytes, h: int) -> bytes:
    """A run without its code point ``h`` % length."""
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def word_counts(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """(word, n): how often each run of at least LEAST_LETTERS letters, ``A-Z`` lower-cased, stands in the whole texts.

    With ``damage``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses one code point first; a null id is
    written as nothing. Null and empty texts have no words; repeated rows count each. Tasks count before they shuffle.
    """

    def letters(word: bytes) -> int:
        return len(word) - word.count(b"\xc3")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for part in sized_batches(batches, "text", BATCH_BYTES):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                if not text:
                    continue
                own = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower()))
                if damage is not None:
                    start = crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
                    for word in list(own):
                        h = crc32(word, start)
                        if h % damage == 0:
                            n, short = own.pop(word), damaged(word, h)
                            if letters(short) >= LEAST_LETTERS:
                                seen[short] += n
                seen.update(own)
                if len(seen) >= MOST_COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
                    seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    return docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def half(longer: int) -> int:
    """So many code points at least are common on one side, when the longer of two words one edit apart has ``longer``."""
    return -(-(longer - 1) // 2)


def halves(words: DataFrame) -> DataFrame:
    """(longer, side, half, word, n): each word in the classes where it is the longer and the shorter, from both sides."""
    length = F.length("word")

    def entry(longer, side):
        t = F.ceil((longer - 1) / 2).cast("int")
        cut = F.substr("word", F.lit(1), t) if side == 0 else F.right("word", t)
        return F.struct(longer.alias("longer"), F.lit(side).alias("side"), cut.alias("half"))

    entries = F.array(*[entry(length + more, side) for more in (0, 1) for side in (0, 1)])
    return words.select("word", "n", F.explode(entries).alias("e")).select("e.longer", "e.side", "e.half", "word", "n")


class Block:
    """Words of one class as matrices of code points, aligned left and right, with their counts and ranks."""

    def __init__(self, words: list[str], n: list[int], longer: int):
        self.words, self.n, self.longer = words, n, longer
        self.left = np.full((len(words), longer), PAD, dtype=np.uint32)
        self.right = np.full((len(words), longer), PAD, dtype=np.uint32)
        lengths = np.array([len(w) for w in words])
        for short in (0, 1):
            rows = np.flatnonzero(lengths == longer - short)
            if len(rows):
                points = np.frombuffer("".join(words[i] for i in rows.tolist()).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(rows), -1)
                self.left[rows, :longer - short] = points
                self.right[rows, short:] = points
        self.full = lengths == longer
        rank = np.empty(len(words), dtype=np.int64)
        rank[sorted(range(len(words)), key=lambda i: (-n[i], words[i]))] = np.arange(len(words))
        self.rank = rank


def common(a: np.ndarray, b: np.ndarray, columns: range) -> np.ndarray:
    """For every row of ``a`` with every row of ``b``: how many of the columns agree, from the first on."""
    same = np.ones((len(a), len(b)), dtype=bool)
    total = np.zeros((len(a), len(b)), dtype=np.int16)
    for c in columns:
        same &= a[:, c, None] == b[None, :, c]
        if not same.any():
            break
        total += same
    return total


def near(block: Block, side: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words of rows ``a`` and ``b`` are one edit apart, as this side counts them.

    A pair whose prefix reaches half is the left side's, any other the right side's, so that no pair counts twice.
    Two of the shorter words are compared in the class where they are the longer ones.
    """
    m, t = block.longer, half(block.longer)
    prefix = common(block.left[a], block.left[b], range(m))
    if side == 0 and not (prefix >= t).any():
        return np.zeros(prefix.shape, dtype=bool)
    suffix = common(block.right[a], block.right[b], range(m - 1, -1, -1))
    mine = prefix >= t if side == 0 else (prefix < t) & (suffix >= t)
    one = (prefix + suffix >= m - 1) & (prefix < m)  # prefix m: the word itself
    return mine & one & (block.full[a][:, None] | block.full[b][None, :])


def compare(block: Block, side: int, part: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """(row, neighbours, best neighbour's row) for the rows that have any; with ``part``, between parts 0 and 1 only."""
    n = len(block.words)
    count = np.zeros(n, dtype=np.int64)
    best = np.full(n, n, dtype=np.int64)
    firsts = np.arange(n) if part is None else np.flatnonzero(part == 0)
    seconds = firsts if part is None else np.flatnonzero(part == 1)
    for i in range(0, len(firsts), TILE):
        for j in range(i if part is None else 0, len(seconds), TILE):
            a, b = firsts[i:i + TILE], seconds[j:j + TILE]
            found = near(block, side, a, b)
            if found.any():
                count[a] += found.sum(axis=1)
                best[a] = np.minimum(best[a], np.where(found, block.rank[b][None, :], n).min(axis=1))
                if part is not None or i != j:
                    count[b] += found.sum(axis=0)
                    best[b] = np.minimum(best[b], np.where(found, block.rank[a][:, None], n).min(axis=0))
    at_rank = np.argsort(block.rank)
    for row in np.flatnonzero(count).tolist():
        yield row, int(count[row]), int(at_rank[best[row]])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (longer, side, half, low, high) to each word's neighbours found there."""

    def answer(rows: list[tuple], crossing: bool) -> Iterator[pa.RecordBatch]:
        block = Block([r[5] for r in rows], [r[6] for r in rows], rows[0][0])
        part = np.array([int(r[7] != r[3]) for r in rows]) if crossing else None
        out = list(compare(block, rows[0][1], part))
        if out:
            own, n_near, best = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.words[i] for i in own], pa.string()), pa.array(n_near, pa.int64()),
                    pa.array([block.n[i] for i in best], pa.int64()), pa.array([block.words[i] for i in best], pa.string()),
                ],
                ["word", "n_near", "best_n", "best"],
            )

    def groups() -> Iterator[list[tuple]]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if group and row[:5] != group[0][:5]:
                    yield group
                    group = []
                group.append(row)
        if group:
            yield group

    packed: list[tuple] = []  # groups of one class and side and of different halves, compared as one tile
    for group in groups():
        if group[0][3] != group[0][4]:
            yield from answer(group, True)
            continue
        other_kind = packed and (group[0][:2] != packed[0][:2] or group[0][2] == packed[-1][2])
        if other_kind or len(packed) + len(group) > TILE:
            if packed:
                yield from answer(packed, False)
            packed = []
        packed += group
    if packed:
        yield from answer(packed, False)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): of each word with words one edit apart, their number and the most frequent of them.

    ``words`` has different words and their counts. Of equally frequent neighbours the first in code-point order
    is taken.
    """
    dealt = halves(words)
    large = dealt.groupBy("longer", "side", "half").agg(F.count("*").alias("n_words")).filter(F.col("n_words") > GROUP_PART)
    large = large.select("longer", "side", "half", F.ceil(F.col("n_words") / GROUP_PART).cast("int").alias("parts"))
    dealt = dealt.join(large, ["longer", "side", "half"], "left")
    own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = dealt.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    tiles = dealt.withColumn("other", other).select(
        "longer", "side", "half", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "word", "n", "own"
    )
    key = ["longer", "side", "half", "low", "high"]
    made = tiles.repartition(*key).sortWithinPartitions(*key).mapInArrow(_tiles, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    found = made.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.word").alias("form"))


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of different words with their counts ``n``; an empty table gives no row.

    The form is the most frequent neighbour if it is at least ``times`` as frequent, else null. Along forms the counts
    grow by that factor, so no chain is longer than the logarithm of the greatest count, and as many rounds of pointer
    jumping as halve that reach every root.
    """
    spark = words.sparkSession
    scratch = Scratch(spark, "spelling")
    words = scratch.write(words.select("word", "n"), "words")
    close = neighbours(words)
    chosen = F.col("form_n") >= F.col("n") * times
    judged = words.join(close, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n"),
    )
    judged = scratch.write(judged, "judged")
    span = judged.agg(F.max("form_n").alias("most"), F.min(F.when(F.col("form").isNotNull(), F.col("n"))).alias("least")).first()
    steps = math.floor(math.log(span.most / span.least, times) + 1e-9) if span.most else 0
    roots = judged.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for k in range(max(0, steps - 1).bit_length()):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = scratch.write(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), f"roots{k}")
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op12_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least LEAST_COUNT occurrences, with its form and root."""
    counts = word_counts(table(spark, sf_dir, "documents"), DAMAGE)
    return variants(counts.filter(F.col("n") >= LEAST_COUNT))
