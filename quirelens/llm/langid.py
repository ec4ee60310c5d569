"""Language identification in two levels: the family first, then one-versus-one linear support vector machines in it.

Texts become hashed counts of one to four letters in a row, damped and of unit length. A bounded sample of labelled
rows, even over the languages, is turned into vectors on the executors; the machines (squared hinge, L2) are fitted
on the driver from those vectors alone. The weights have a fixed size for each pair of classes and are sent with the
tasks. Prediction reads each text once and moves no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import held_out, learnable, query, sized_batches, table

DIMS = 4096
GRAMS = (1, 2, 3, 4)
SAMPLE_ROWS = 8000  # labelled rows fitted on, over all languages
MOST_LANGUAGES = 400
ROUNDS = 150
PENALTY = 1e-4
STEEPNESS = 4.0
BATCH_BYTES = 4 << 20
UNKNOWN = "und"

#: Families by language code; a code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la lmo oc pt rm ro scn",
    "slavic": "be bg bs cs hr hsb mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv kw",
    "uralic": "et fi hu se",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "iranian": "ckb fa ku ps tg",
    "indic": "as bn gu hi kn ml mr ne or pa sa si ta te ur",
    "semitic": "am ar he mt ti",
    "malayic": "ceb id jv ms su tl",
    "hellenic": "el",
    "sinitic": "wuu yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """The hashed vector of a whole text: all runs of other characters than letters count as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    # letters of any script: ASCII ones, and everything from U+00AA on but general punctuation
    letter = ((points >= 97) & (points <= 122)) | ((points >= 0xAA) & ((points < 0x2000) | (points > 0x206F)))
    x = np.where(letter, points, np.uint32(32))
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32)
    x = np.concatenate(([32], x[keep], [32])).astype(np.uint32)
    counts = np.zeros(DIMS, dtype=np.float32)
    h = np.zeros(len(x), dtype=np.uint32)
    for n in GRAMS:
        if len(x) < n:
            break
        h = h[: len(x) - n + 1] * np.uint32(0x01000193) + x[n - 1:] * np.uint32(0x9E3779B1)
        mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed >> np.uint32(20), minlength=DIMS).astype(np.float32)
    counts = np.sqrt(counts)
    return counts / max(float(np.linalg.norm(counts)), 1e-9)


def fit_machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and offset of one linear machine for y in {-1, 1}: squared hinge with classes weighed alike, accelerated descent."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], dtype=np.float32)
    ahead = w.copy()
    rate = 1.0 / (2 * 2.0 + PENALTY)  # rows have a squared length of 2, weights sum to 1
    for k in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ ahead)) * share
        new = ahead - rate * (PENALTY * ahead - 2 * (x.T @ (slack * y)))
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


@dataclass
class LanguageModel:
    """Classes by family, and one weight vector for each pair of families and for each pair of languages in a family."""

    families: list[str]
    languages: dict[str, list[str]]
    between: dict[tuple[str, str], np.ndarray]
    within: dict[tuple[str, str], np.ndarray]

    @staticmethod
    def _vote(x: np.ndarray, classes: list[str], machines: dict[tuple[str, str], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Winner by pairwise strength and its mean chance against the others, for each row."""
        strength = np.zeros((len(x), len(classes)), dtype=np.float64)
        for i, j in combinations(range(len(classes)), 2):
            w = machines[classes[i], classes[j]]
            p = 1 / (1 + np.exp(-STEEPNESS * np.clip(x @ w[:-1] + w[-1], -20, 20)))
            strength[:, i] += p
            strength[:, j] += 1 - p
        best = strength.argmax(axis=1)
        return best, strength[np.arange(len(x)), best] / max(1, len(classes) - 1) if len(classes) > 1 else np.ones(len(x))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        family, chance = self._vote(x, self.families, self.between)
        names, scores = [""] * len(x), chance.copy()
        for k, name in enumerate(self.families):
            rows = np.flatnonzero(family == k)
            if len(rows):
                best, p = self._vote(x[rows], self.languages[name], self.within)
                scores[rows] *= p
                for r, b in zip(rows.tolist(), best.tolist()):
                    names[r] = self.languages[name][b]
        return names, scores


def sample_rows(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled rows for fitting: from each language about the same number, ``rows`` in all, taken by a hash of the id.

    The counts are one row a language; what is taken does not depend on how the rows lie in partitions.
    """
    usable = docs.filter(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to tell apart")
    if not counts:
        return usable.select("lang", "text").limit(0)
    each = rows // len(counts)
    chance = F.lit(0.0)
    for lang, n in counts.items():
        chance = F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))).otherwise(chance)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30)) < chance * (1 << 30)
    return usable.filter(drawn).select("lang", "text")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sized_batches(batches, "text", BATCH_BYTES):
        made = [np.round(features(t) * 60000).astype("<u2").tobytes() if LETTER.search(t) else None for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang").combine_chunks(), pa.array(made, pa.binary())], ["lang", "vector"])


def train(docs: DataFrame) -> LanguageModel:
    """A model from the labelled rows outside the held-out fold."""
    found = sample_rows(docs).mapInArrow(_vectors, "lang string, vector binary").filter("vector is not null").collect()
    found.sort(key=lambda r: (r.lang, bytes(r.vector)))  # whatever the order of tasks, the same sums
    langs = np.array([r.lang for r in found], dtype=object)
    x = np.zeros((len(found), DIMS), dtype=np.float32)
    for i, r in enumerate(found):
        x[i] = np.frombuffer(r.vector, dtype="<u2")
    del found
    x /= 60000
    family = np.array([FAMILY_OF.get(v, f"only {v}") for v in langs], dtype=object)
    families = sorted(set(family.tolist()))
    languages = {f: sorted(set(langs[family == f].tolist())) for f in families}

    def pairs(labels: np.ndarray, classes: list[str]) -> dict[tuple[str, str], np.ndarray]:
        made = {}
        for a, b in combinations(classes, 2):
            rows = (labels == a) | (labels == b)
            made[a, b] = fit_machine(x[rows], np.where(labels[rows] == a, 1, -1).astype(np.float32))
        return made

    within: dict[tuple[str, str], np.ndarray] = {}
    for f in families:
        within |= pairs(langs, languages[f])
    return LanguageModel(families, languages, pairs(family, families), within)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Adds nothing to and drops nothing from the rows: (doc_id, held_out, lang_pred, score) for each, also repeated ones.

    Null texts, texts without a letter, and any text under a model without classes give ``und`` with score 0. Only
    ``doc_id`` and ``text`` are read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # DIMS weights for each pair of at most MOST_LANGUAGES classes

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for part in sized_batches(batches, "text", BATCH_BYTES):
            texts = part.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            use = [i for i, t in enumerate(texts) if t and known.families and LETTER.search(t)]
            for start in range(0, len(use), 512):
                rows = use[start:start + 512]
                got, p = known.predict(np.stack([features(texts[i]) for i in rows]))
                scores[rows] = p
                for i, name in zip(rows, got):
                    names[i] = name
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").combine_chunks(), part.column("held_out").combine_chunks(), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
