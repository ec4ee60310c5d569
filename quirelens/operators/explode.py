"""Volumes unfolded into pages, tokens, tags and zones; record audits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.functions import ids
from quirelens.settings import CHAR_MAPS, TOKEN_MAP, ZONES


def unfold(rows: DataFrame, array: Column | str, name: str, *keep: Column | str) -> DataFrame:
    """One row per non-null element of an array.

    A plain ``explode`` makes the optimizer add a filter on the array's size below it, which computes the
    array twice; the outer form with a filter on the element computes it once.
    """
    return rows.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def unfold_map(rows: DataFrame, entries: Column | str, key: str, value: str, *keep: Column | str) -> DataFrame:
    """One row per entry of a map, computed once as in ``unfold``."""
    return rows.select(*keep, F.explode_outer(entries).alias(key, value)).filter(F.col(key).isNotNull())


def computed_once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a costly value that later filters refer to.

    A filter on a projected column is pushed below it, value and all; on a generated one it is not.
    """
    return rows.select("*", F.explode_outer(F.array(value)).alias(name))


def language_labels(languages: Column) -> Column:
    """Version 1.5: all keys of the ``languages`` array of maps, in order."""
    return F.coalesce(F.flatten(F.transform(languages, F.map_keys)), F.array().cast("array<string>"))


def language_label(calculated: Column) -> Column:
    """Version 2: the calculated language as an array of zero or one label."""
    return F.when(calculated.isNotNull(), F.array(calculated)).otherwise(F.array().cast("array<string>"))


def explode_pages(volumes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page entry that lies inside ``page_count`` and is not null."""
    page_fields = volumes.schema["pages"].dataType.elementType.fieldNames()
    labels = language_labels(F.col("page.languages")) if "languages" in page_fields else language_label(F.col("page.calculatedLanguage"))
    return (
        volumes.select("volume_id", "page_count", *keep, F.posexplode_outer("pages").alias("page_index", "page"))
        .filter((F.col("page_index") < F.col("page_count")) & F.col("page").isNotNull())
        .select(
            "volume_id",
            ids.page_id(F.col("volume_id"), F.col("page_index")).alias("page_id"),
            "page_index",
            labels.alias("langs"),
            *keep,
            *[F.col(f"page.{z}").alias(z) for z in ZONES if z in page_fields],
        )
    )


def indexable_pages(pages: DataFrame) -> DataFrame:
    """Pages that yield a document: body and its token counts are present."""
    return pages.filter(F.col("body.tokenPosCount").isNotNull())


def token_arrays(pages: DataFrame) -> DataFrame:
    """Indexable pages with their tokens as one array: no row is exploded."""
    tokens = F.transform(
        F.map_entries("body.tokenPosCount"),
        lambda e: F.struct(
            e["key"].alias("token"),
            F.coalesce(F.map_keys(e["value"]), F.array().cast("array<string>")).alias("pos_tags"),
        ),
    )
    return indexable_pages(pages).withColumn("tokens", tokens).drop(*ZONES)


def explode_tokens(pages: DataFrame) -> DataFrame:
    """One row per body token with its tags; the stored counts are not used."""
    return (
        unfold_map(indexable_pages(pages), "body.tokenPosCount", "token", "counts", "volume_id", "page_id", "langs")
        .select(
            "volume_id",
            "page_id",
            "langs",
            "token",
            F.coalesce(F.map_keys("counts"), F.array().cast("array<string>")).alias("pos_tags"),
        )
    )


def explode_pos(page_tokens: DataFrame) -> DataFrame:
    """One row per page, token and tag."""
    kept = [c for c in page_tokens.columns if c != "pos_tags"]
    return unfold(page_tokens, "pos_tags", "tag", *kept)


def token_ranges(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, n_tokens, n_tags, first_token, last_token) out of rows (keys, token, n_tags): how many, and the least and greatest.

    Text cannot be kept in a hash aggregate, so Spark would sort the rows by their keys; a task's rows are many times its
    text. Here each batch is added up by itself, and only a row for each batch and key is sorted and shuffled.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            found = table.group_by(list(keys)).aggregate([("token", "count"), ("n_tags", "sum"), ("token", "min"), ("token", "max")])
            made = found.select([*keys, "token_count", "n_tags_sum", "token_min", "token_max"]).rename_columns([*keys, "n_tokens", "n_tags", "first_token", "last_token"])
            yield from made.to_batches()

    each = rows.select(*keys, "token", F.col("n_tags").cast("bigint").alias("n_tags"))
    parts = each.mapInArrow(add, ", ".join(f"`{k}` string" for k in keys) + ", n_tokens long, n_tags long, first_token string, last_token string")
    return parts.groupBy(*keys).agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum("n_tags").alias("n_tags"), F.min("first_token").alias("first_token"), F.max("last_token").alias("last_token")
    )


def explode_zones(pages: DataFrame) -> DataFrame:
    """One row per page, zone and count map present: ``counts`` holds the map, token tags flattened out."""
    zones = F.array(*[F.struct(F.lit(z).alias("zone"), F.col(z).alias("z")) for z in ZONES])
    one = pages.select("volume_id", "page_id", F.explode(zones).alias("e")).select("volume_id", "page_id", "e.zone", "e.z")
    # the parser leaves counts as text; one that is not a whole number is null, and no part of a token's total
    whole = lambda n: n.try_cast("bigint")
    zero = F.lit(0).cast("bigint")
    total = lambda tags: F.aggregate(F.map_values(tags), zero, lambda a, n: a + F.coalesce(whole(n), zero))
    totals = F.transform_values(f"z.{TOKEN_MAP}", lambda _, tags: total(tags))
    chars = [F.transform_values(f"z.{m}", lambda _, n: whole(n)) for m in CHAR_MAPS]
    named = zip([*CHAR_MAPS, TOKEN_MAP], [*chars, totals])
    maps = F.array(*[F.struct(F.lit(name).alias("count_map"), counts.alias("counts")) for name, counts in named])
    per_map = unfold(one.filter(F.col("z").isNotNull()), maps, "m", "volume_id", "page_id", "zone")
    named = per_map.select("volume_id", "page_id", "zone", "m.count_map", "m.counts")
    return unfold_map(named, "counts", "key", "n", "volume_id", "page_id", "zone", "count_map")


def audit_page_counts(volumes: DataFrame) -> DataFrame:
    """Volumes whose page array is not as long as the page count they state."""
    return volumes.select("volume_id", "page_count", F.size("pages").alias("n_pages")).filter(
        F.col("n_pages") != F.col("page_count")
    )


def missing_metadata(volumes: DataFrame) -> DataFrame:
    return volumes.filter(F.col("metadata").isNull()).select("volume_id")
