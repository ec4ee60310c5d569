"""The corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark passages are cut out,
personal data is masked, and what is left is packed into sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quirelens.llm import decontamination, jaccard, packing, pii, toxicity
from quirelens.llm.common import Scratch, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go.

    Null and empty texts are judged by the model's offset and stay where most labelled rows are harmless; equal rows
    stay or go together; an empty table stays empty. All columns stay, whatever their names.
    """
    return toxicity.keep_harmless(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle sets, the document with the smallest id stays.

    Documents without words all stay; of repeated rows one stays; an empty table stays empty. All columns stay.
    """
    return jaccard.keep_one(docs)


def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out of the texts.

    Null texts stay null, and every row stays, also one that nothing is left of. All columns stay.
    """
    return decontamination.remove_passages(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal its bearers are masked.

    Null texts stay null; every row and column stays, repeated rows are masked alike.
    """
    return pii.sanitise(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document gets its sequence and place.

    A null or empty text is a piece of one id; repeated rows are packed each for itself; an empty table gives no piece.
    """
    return packing.pack(docs, release=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: No stage but the fourth's fixed forms can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as a table and read again for the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
