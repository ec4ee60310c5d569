"""Periodic runs of words: recursive frequency splitting, then a lag scan of what survives.

A run repeats a group of words at least three times, so each of its words occurs at least three times in any segment
that holds the run. Words that occur more rarely than that split a segment; the parts are judged again by their own
counts, until nothing splits. Prose falls apart at once. In a segment that is left, each lag is tried at sample
places only: a run's words equal those one period on over a stretch at least as long as the distance between samples.
Documents are independent, so no rows are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import query, sized_batches, table

LEAST_WORDS = 24
LEAST_REPEATS = 3
BATCH_BYTES = 4 << 20
WORD = r"[^\x20\x09-\x0D]+"
RUN_DDL = "array<struct<start: long, length: long, period: long>>"


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word's number, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))


def segments(ids: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[tuple[int, int]]:
    """Stretches of at least ``least`` words in which every word occurs at least ``repeats`` times, found by splitting."""
    kept, open_ = [], [(0, len(ids))]
    while open_:
        start, end = open_.pop()
        if end - start < least:
            continue
        part = ids[start:end]
        if part.max() > 4 * len(part):  # a short part of a long text: number its words anew
            part = np.unique(part, return_inverse=True)[1]
        cuts = np.flatnonzero(np.bincount(part)[part] < repeats)
        if not len(cuts):
            kept.append((start, end))
            continue
        edges = np.concatenate(([-1], cuts, [end - start]))
        wide = np.flatnonzero(np.diff(edges) > least)
        open_ += [(start + int(edges[k]) + 1, start + int(edges[k + 1])) for k in wide]
    return kept


def _stretch(w: np.ndarray, at: int, lag: int, step: int) -> tuple[int, int]:
    """The greatest [a, b) around ``at`` in which every word equals the one ``lag`` later."""
    right, size, last = at + 1, step, len(w) - lag
    while right < last:
        same = w[right:min(right + size, last)] == w[right + lag:min(right + size, last) + lag]
        if not same.all():
            right += int(same.argmin())
            break
        right, size = right + len(same), size * 2
    left, size = at, step
    while left > 0:
        low = max(0, left - size)
        same = (w[low:left] == w[low + lag:left + lag])[::-1]
        if not same.all():
            left -= int(same.argmin())
            break
        left, size = low, size * 2
    return left, right


def lag_scan(w: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[tuple[int, int, int]]:
    """Every maximal (start, length, smallest period) of at least ``least`` words and ``repeats`` periods."""
    found: list[tuple[int, int, int]] = []
    known = np.zeros((0, 3), dtype=np.int64)
    for lag in range(1, len(w) // repeats + 1):
        step = max((repeats - 1) * lag, least - lag)
        places = np.arange(0, len(w) - lag, step)
        hits = places[w[places] == w[places + lag]]
        if not len(hits):
            continue
        # within a run whose period divides the lag, the words agree because of that run alone
        if len(known) < len(found):
            known = np.array(found, dtype=np.int64)
        for start, length, _ in known[(lag % known[:, 2] == 0) & (known[:, 1] > lag)].tolist():
            hits = hits[(hits < start) | (hits + lag >= start + length)]
        done = -1
        for at in hits.tolist():
            if at < done:
                continue
            left, done = _stretch(w, at, lag, step)
            if done - left >= step:
                found.append((left, done - left + lag, lag))
    return found


def runs_of(words: list[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a document's words, by start, then period."""
    if len(words) < LEAST_WORDS:
        return []
    ids = numbered(words)
    return sorted((start + a, n, q) for start, end in segments(ids) for a, n, q in lag_scan(ids[start:end]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): each document's runs by start, then period, and its text with every run cut to one period.

    A null or empty text has no runs and collapses to an empty text. Repeated rows and ids, null ids too, are judged
    each for itself; an empty table gives no row. Only ``doc_id`` and ``text`` are read, whatever else there is.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized_batches(batches, "text", BATCH_BYTES):
            runs, texts = [], []
            for text in part.column("text").to_pylist():
                words = words_of(text)
                found = runs_of(words)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                texts.append(collapsed(words, found).decode("utf-8", "surrogatepass"))
            columns = [part.column("doc_id").combine_chunks(), pa.array(runs, pa.list_(struct)), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, runs {RUN_DDL}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, the words from a drawn place on repeat a group of drawn length.

    With h the crc32 of the id as text and g = h / 10: if 10 divides h, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) / (3 + g % 8). Texts without words, and rows without an id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    drawn = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", F.when(drawn, h.cast("long")).alias("h"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    rows = rows.select("doc_id", "text", "h", F.when(F.col("h").isNotNull(), words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    rows = rows.select("doc_id", "text", "w", n.alias("n"), F.when(n > 0, g).alias("g"))
    rows = rows.withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    p = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    rows = rows.withColumn("p", p.cast("int"))
    head = F.slice("w", F.lit(1), F.col("a"))
    group = F.slice("w", F.col("a") + 1, F.col("p"))
    again = F.flatten(F.array_repeat(group, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    made = F.array_join(F.slice(F.concat(head, again), F.lit(1), F.col("n")), " ")
    return rows.select("doc_id", F.when(F.col("g").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def greatest(runs: Column) -> Column:
    """Of runs by start, then period, the first with the greatest exact length / period; null without runs."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


@query("op13_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, with planted repeats: their number, the greatest, and digests of all and of what is left."""
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", greatest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
