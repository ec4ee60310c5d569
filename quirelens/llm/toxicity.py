"""Toxicity by logistic regression with the FTRL-proximal method over hashed word n-grams and skip-grams.

Every weight has its own learning rate and L1 shrinkage sets most to exactly zero, so the model is a short sorted
list of (slot, weight) sent with the tasks. Labels are joined to texts through a sample of labelled ids, bounded in
rows and in bytes of text; its features are made on the executors, one task passes over them, and the driver gets the
weights only. Scoring reads each text once and moves no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import held_out, learnable, query, sized_batches, table

SLOTS_LOG2 = 20
SAMPLE_ROWS = 12_000  # labelled rows fitted on, at most half of them of one label
SAMPLE_BYTES = 64 << 20  # of their texts; a sample of longer texts has fewer rows
EPOCHS = 5
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 0.0
THRESHOLD = 0.3
BATCH_BYTES = 4 << 20
WORDS = re.compile(r"[^\W\d_]+")


def slots(text: str) -> np.ndarray:
    """Distinct hashed features of a whole text: words, neighbours, and words one or two apart."""
    words = WORDS.findall(text.lower())
    if not words:
        return np.zeros(0, dtype=np.uint32)
    h = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), dtype=np.uint64, count=len(words))
    made = [h * np.uint64(0x9E3779B97F4A7C15)]
    for gap, factor in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9), (3, 0x27D4EB2F165667C5)):
        made.append((h[:-gap] * np.uint64(factor) ^ (h[gap:] + np.uint64(gap))) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(np.concatenate(made) >> np.uint64(64 - SLOTS_LOG2)).astype(np.uint32)


@dataclass
class ToxicityModel:
    """Slots with a weight other than zero, in order, their weights, and the offset."""

    index: np.ndarray
    weight: np.ndarray
    offset: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            total = self.offset
            if text and len(self.index):
                s = slots(text)
                at = np.minimum(np.searchsorted(self.index, s), len(self.index) - 1)
                total += float(self.weight[at][self.index[at] == s].sum())
            out[i] = total
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(rows: list[tuple[np.ndarray, float]]) -> ToxicityModel:
    """FTRL-proximal over (slots, label) rows, in the given order, EPOCHS times.

    The offset is a feature of its own without shrinkage. Without rows every score is one half.
    """
    size = 1 << SLOTS_LOG2
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for s, label in rows:
            zs, ns = z[s], n[s]
            w = weights(zs, ns)
            bias = -bias_z / ((BETA + bias_n**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30)))
            g = p - label
            rate = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[s] = zs + g - rate * w
            n[s] = ns + g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / ALPHA * bias
            bias_n += g * g
    w = weights(z, n)
    index = np.flatnonzero(w).astype(np.uint32)
    return ToxicityModel(index, w[index], -bias_z / ((BETA + bias_n**0.5) / ALPHA))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, toxic, text) of about ``rows`` labelled documents outside the held-out fold at most, and each label's drawn share.

    Labels that repeat for an id count as the greatest. Ids are drawn by hash, of each label at most half of
    ``rows``; where their texts have more than ``most_bytes``, that part of them is drawn which fits, of both labels
    alike. Texts are fetched by broadcasting the drawn ids, whose number is bounded by ``rows``.
    """
    usable = labels.filter(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, rows / 2 / n) for k, n in counts.items()}

    def drawn(part: float) -> DataFrame:
        chance = F.when(F.col("toxic") == 1, share.get(1, 0.0) * part).otherwise(share.get(0, 0.0) * part)
        chosen = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30)) < chance * (1 << 30)
        return docs.select("doc_id", "text").join(F.broadcast(usable.filter(chosen)), "doc_id")

    held = drawn(1.0).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return drawn(min(1.0, most_bytes / held) if held else 1.0), share


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sized_batches(iter([batch]), "text", BATCH_BYTES):
            made = [slots(t or "").astype("<u4").tobytes() for t in part.column("text").to_pylist()]
            ids = part.column("doc_id").to_pylist()
            order = [crc32(str(i).encode()) for i in ids]
            columns = [pa.array(order, pa.int64()), pa.array(map(str, ids), pa.string()), part.column("toxic").combine_chunks(), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "id", "toxic", "slots"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [
        (np.frombuffer(s, dtype="<u4"), float(y))
        for batch in batches for s, y in zip(batch.column("slots").to_pylist(), batch.column("toxic").to_pylist())
    ]
    model = fit(rows)
    columns = [[model.index.astype("<u4").tobytes()], [model.weight.astype("<f8").tobytes()], [model.offset]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slots", "weights", "offset"])


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model from the labelled documents outside the held-out fold; its offset fits the labels' true shares.

    One task fits, on a sample that ``labelled_sample`` bounds; without rows every score is one half.
    """
    sample, share = labelled_sample(docs, labels)
    features = sample.mapInArrow(_features, "place long, id string, toxic int, slots binary")
    ordered = features.repartition(1).sortWithinPartitions("place", "id", "toxic", "slots")
    found = ordered.mapInArrow(_fitted, "slots binary, weights binary, offset double").collect()  # at most 2**SLOTS_LOG2 weights
    if not found:
        return fit([])
    model = ToxicityModel(np.frombuffer(found[0].slots, dtype="<u4"), np.frombuffer(found[0].weights, dtype="<f8"), found[0].offset)
    if len(share) == 2:
        model.offset += float(np.log(share[0] / share[1]))
    return model


def score(docs: DataFrame, model: ToxicityModel, *carried: str) -> DataFrame:
    """Every row's ``score`` and ``predicted``, with the ``carried`` columns, and ``text`` if it is among them.

    Null and empty texts get the offset's score. One row comes out for each that goes in; further columns are not
    read, and carried ones named ``score`` or ``predicted`` are refused.
    """
    if {"score", "predicted"} & set(carried):
        raise ValueError("score and predicted are made here")
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**SLOTS_LOG2 weights
    read = [c for c in dict.fromkeys([*carried, "text"])]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized_batches(batches, "text", BATCH_BYTES):
            p = sent.value.scores(part.column("text").to_pylist())
            columns = [part.column(c).combine_chunks() for c in carried]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))], [*carried, "score", "predicted"])

    made = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*carried).schema)
    return docs.select(*read).mapInArrow(scored, f"{made}score double, predicted int")


def keep_harmless(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, whatever their names.

    Null and empty texts are judged by the offset alone; repeated rows stay or go together; an empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized_batches(batches, "text", BATCH_BYTES):
            harmless = part.filter(pa.array(sent.value.scores(part.column("text").to_pylist()) < THRESHOLD))
            yield from harmless.combine_chunks().to_batches()

    return docs.mapInArrow(keep, docs.schema)


@query("op6_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score(rows, model, "doc_id", "held_out")
