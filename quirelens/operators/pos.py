"""Mapping of source part-of-speech tags to universal tags; ``pos_map`` is a table (lang, tag, upos)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.operators.lookup import left_lookup
from quirelens.settings import EMBED_MAX_ROWS, UNKNOWN_SOURCE_TAG, UNMAPPED_TAG


def mapped_languages(pos_map: DataFrame) -> DataFrame:
    return pos_map.select("lang").distinct()


def one_entry(pos_map: DataFrame, *keys: str) -> DataFrame:
    """The map with each key once: of repeated entries the greatest ``upos`` counts."""
    return pos_map.groupBy(*keys).agg(F.max("upos").alias("upos"))


def pos_lookup(rows: DataFrame, pos_map: DataFrame) -> DataFrame:
    """(lang, tag) to ``upos``, NULL when there is none."""
    return left_lookup(rows, one_entry(pos_map, "lang", "tag"), ["lang", "tag"])


def pos_lookup_checked(rows: DataFrame, pos_map: DataFrame) -> DataFrame:
    """As ``pos_lookup``, with ``''`` for a language without a map and ``X`` for a missing tag."""
    has_map = mapped_languages(pos_map).withColumn("_mapped", F.lit(True))
    found = left_lookup(pos_lookup(rows, pos_map), has_map, ["lang"])
    checked = F.when(F.col("_mapped").isNull(), F.lit("")).otherwise(F.coalesce("upos", F.lit(UNMAPPED_TAG)))
    return found.withColumn("upos", checked).drop("_mapped")


def pos_pair(rows: DataFrame, pos_map: DataFrame, max_embed: int = EMBED_MAX_ROWS) -> DataFrame:
    """Add (lang, upos, defaulted): the first of ``langs`` whose map has ``tag``.

    When none has it, lang is the first language and upos ``X``, or NULL if that language has no map;
    ``defaulted`` marks the ``X`` made that way. A map of bounded size becomes a constant of the plan and
    the pair a projection; with a larger one the distinct (langs, tag) combinations are resolved by join.
    """
    tree = embedded_map(pos_map, max_embed)
    if tree is None:
        return _pos_pair_by_join(rows, pos_map)
    pair = resolve_pair(F.col("langs"), F.col("tag"), tree)
    return rows.withColumn("_pair", pair).select(*rows.columns, "_pair.lang", "_pair.upos", "_pair.defaulted")


def _pos_pair_by_join(rows: DataFrame, pos_map: DataFrame) -> DataFrame:
    combos = rows.select("langs", "tag").distinct().filter(F.size("langs") > 0)
    tried = combos.select("langs", "tag", F.posexplode("langs").alias("place", "lang"))
    found = tried.join(one_entry(pos_map, "lang", "tag"), ["lang", "tag"], "left")
    found = found.join(mapped_languages(pos_map).withColumn("_mapped", F.lit(True)), "lang", "left")
    hit = F.when(F.col("upos").isNotNull(), F.col("place"))
    resolved = found.groupBy("langs", "tag").agg(
        F.min_by(F.struct("lang", "upos"), hit).alias("first_hit"),
        F.min_by(F.struct("lang", "_mapped"), F.col("place")).alias("first_lang"),
    )
    fallback = F.when(F.col("first_lang._mapped"), F.lit(UNMAPPED_TAG))
    side = resolved.select(
        F.to_json("langs").alias("_langs"),
        "tag",
        F.coalesce("first_hit.lang", "first_lang.lang").alias("lang"),
        F.coalesce("first_hit.upos", fallback).alias("upos"),
        (F.col("first_hit.upos").isNull() & fallback.isNotNull()).alias("defaulted"),
    )
    # One common pair may hold a large share of the rows: adaptive execution splits it.
    keyed = rows.withColumn("_langs", F.to_json("langs"))
    return keyed.join(side, ["_langs", "tag"], "left").drop("_langs").withColumn(
        "defaulted", F.coalesce("defaulted", F.lit(False))
    )


def pos_pair_homogeneous(rows: DataFrame, tag_map: DataFrame) -> DataFrame:
    """One tag map (tag, upos) for all languages; the language is always the first one.

    Without a match only the tag ``UKN`` becomes ``X``; any other tag stays NULL.
    """
    found = left_lookup(rows, one_entry(tag_map, "tag"), ["tag"])
    fallback = F.when(F.col("tag") == UNKNOWN_SOURCE_TAG, F.lit(UNMAPPED_TAG))
    return found.withColumn("lang", F.get("langs", F.lit(0))).withColumn("upos", F.coalesce("upos", fallback))


def pos_checked_homogeneous(rows: DataFrame, tag_map: DataFrame) -> DataFrame:
    """One tag map: ``UKN`` becomes ``''``, a missing tag ``X``."""
    found = left_lookup(rows, one_entry(tag_map, "tag"), ["tag"])
    checked = F.when(F.col("tag") == UNKNOWN_SOURCE_TAG, F.lit("")).otherwise(F.coalesce("upos", F.lit(UNMAPPED_TAG)))
    return found.withColumn("upos", checked)


def merge_tag_maps(pos_map: DataFrame) -> DataFrame:
    """All languages' maps as one: of a tag mapped more than once, the last language's entry stays."""
    return pos_map.groupBy("tag").agg(F.max_by("upos", "lang").alias("upos"))


def missing_pos(rows: DataFrame, pos_map: DataFrame) -> DataFrame:
    """How often each ``lang:tag`` fell back to ``X``: a mapped first language, and no language has the tag.

    Rows are counted by (langs, tag) before any is resolved.
    """
    counted = rows.groupBy("langs", "tag").agg(F.count(F.lit(1)).alias("n"))
    return (
        pos_pair(counted, pos_map)
        .filter("defaulted")
        .groupBy("lang", "tag")
        .agg(F.sum("n").alias("n"))
        .select(F.concat_ws(":", "lang", "tag").alias("lang_tag"), "n")
    )


def map_coverage(rows: DataFrame, pos_map: DataFrame) -> DataFrame:
    """Rows' languages with their frequency, whether they have a map, and the number of mapped languages."""
    has_map = mapped_languages(pos_map).withColumn("mapped", F.lit(True))
    n_mapped = pos_map.agg(F.count_distinct("lang"))
    return (
        left_lookup(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), has_map, ["lang"])
        .withColumn("mapped", F.coalesce("mapped", F.lit(False)))
        .withColumn("n_mapped_languages", n_mapped.scalar())
    )


def embedded_map(pos_map: DataFrame, max_rows: int = EMBED_MAX_ROWS) -> Column | None:
    """The map as a constant ``map<lang, map<tag, upos>>``; None when it has more than ``max_rows`` entries."""
    entries = one_entry(pos_map, "lang", "tag").limit(max_rows + 1).collect()
    if len(entries) > max_rows:
        return None
    tree: dict[str, dict[str, str]] = {}
    for e in entries:
        tree.setdefault(e["lang"], {})[e["tag"]] = e["upos"]
    return F.from_json(F.lit(json.dumps(tree)), "map<string, map<string, string>>")


def resolve_pair(langs: Column, tag: Column, tree: Column) -> Column:
    """``pos_pair`` for one row: struct(lang, upos, defaulted) out of a constant map."""

    def look(lang: Column) -> Column:
        return F.try_element_at(F.try_element_at(tree, lang), tag)

    first = F.get(langs, F.lit(0))
    hit = F.get(F.filter(langs, lambda lang: look(lang).isNotNull()), F.lit(0))
    fallback = F.when(F.try_element_at(tree, first).isNotNull(), F.lit(UNMAPPED_TAG))
    return F.struct(
        F.coalesce(hit, first).alias("lang"),
        F.coalesce(look(hit), fallback).alias("upos"),
        (hit.isNull() & fallback.isNotNull()).alias("defaulted"),
    )
