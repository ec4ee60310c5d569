"""Frequency tables and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quirelens.operators.explode import explode_pos, unfold
from quirelens.operators.terms import terms


def frequency(rows: DataFrame, key: str, keep_null: bool = False) -> DataFrame:
    """(key, n) by falling n; equal counts are ordered by key."""
    kept = rows if keep_null else rows.filter(F.col(key).isNotNull())
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), key)


def word_frequency(page_tokens: DataFrame, tokenize: bool = True) -> DataFrame:
    """Lowercased terms, one per page, token and term: stored counts do not enter.

    Raw tokens are counted first, so that only different tokens are broken into terms.
    """
    if not tokenize:
        return frequency(terms(page_tokens, tokenize=False), "term", keep_null=True)
    tokens = page_tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return terms(tokens, lower=True).groupBy("term").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "term")


def pos_frequency(page_tokens: DataFrame) -> DataFrame:
    return frequency(explode_pos(page_tokens), "tag")


def page_lang_frequency(pages: DataFrame) -> DataFrame:
    return frequency(unfold(pages, "langs", "lang"), "lang", keep_null=True)


def catalog_languages(metadata: Column) -> Column:
    """``metadata.language`` of a VARIANT as an array: a string, or an array of strings."""
    whole = F.try_variant_get(metadata, "$.language", "variant")
    shape = F.schema_of_variant(whole)
    return F.when(shape == "STRING", F.array(F.try_variant_get(metadata, "$.language", "string"))).when(
        F.startswith(shape, F.lit("ARRAY")), F.try_variant_get(metadata, "$.language", "array<string>")
    )


def catalog_lang_frequency(volumes: DataFrame, keep_null: bool = False) -> DataFrame:
    """Catalogue languages of volumes. Empty ones are skipped, or with ``keep_null`` counted under NULL."""
    langs = F.explode_outer(catalog_languages(F.col("metadata")))
    rows = volumes.select(langs.alias("lang")).select(F.nullif(F.col("lang"), F.lit("")).alias("lang"))
    return frequency(rows, "lang", keep_null)


def volume_count(volumes: DataFrame) -> DataFrame:
    return volumes.agg(F.count(F.lit(1)).alias("n_volumes"))


def pages_per_volume(volumes: DataFrame) -> DataFrame:
    """Length of the page array, 0 where there is none."""
    return volumes.select("volume_id", F.coalesce(F.size("pages"), F.lit(0)).alias("n_pages")).withColumn(
        "n_pages", F.greatest("n_pages", F.lit(0))
    )


def volume_total(files: DataFrame) -> DataFrame:
    return files.agg(F.coalesce(F.sum(F.lit(1)), F.lit(0)).alias("n_volumes"))


def page_total(volumes: DataFrame) -> DataFrame:
    """Sum of the stated page counts; a missing one counts 0."""
    return volumes.agg(F.sum(F.coalesce(F.col("page_count").cast("long"), F.lit(0))).alias("n_pages"))


def concept_record_count(concepts: DataFrame) -> DataFrame:
    return concepts.agg(F.count(F.lit(1)).alias("n_records"))


def dictionary_size(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_words"))


def progress(done: DataFrame, total: DataFrame, key: str, group: str) -> DataFrame:
    """(group, n_done, n_total, percent): how many of a group's keyed rows are done. A key counts once, a group with none done too."""
    flags = total.select(key, group).distinct().join(done.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    found = flags.groupBy(group).agg(F.count("_done").alias("n_done"), F.count(F.lit(1)).alias("n_total"))
    return found.withColumn("percent", F.lit(100.0) * F.col("n_done") / F.col("n_total"))


def observed(rows: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """Rows with a counter of them attached: read it from the observation after the action that runs them."""
    watch = Observation(name)
    return rows.observe(watch, F.count(F.lit(1)).alias("n_rows")), watch
