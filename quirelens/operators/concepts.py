"""Concept records turned into partial-update commands, and the effect of applying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens import settings as S
from quirelens.functions import ids, jsontext
from quirelens.operators.explode import unfold

CONCEPT = "concept"


def concept_texts(concepts: Column) -> Column:
    """The texts that are present; duplicates stay."""
    texts = F.transform(concepts, lambda c: c["text"])
    return F.coalesce(F.filter(texts, lambda t: t.isNotNull()), F.array().cast("array<string>"))


def update_field_names(name: Column | str, level: str) -> Column:
    """The two fields a partial update of ``name`` writes."""
    base = F.lit(name) if isinstance(name, str) else name
    if level == "page":
        base = F.concat(F.lit("volume"), base)
        return F.array(F.concat(base, F.lit(S.PAGE_TEXT_SUFFIX)), F.concat(base, F.lit(S.PAGE_FACETS_SUFFIX)))
    return F.array(F.concat(base, F.lit(S.VOLUME_TEXT_SUFFIX)), F.concat(base, F.lit(S.VOLUME_FACETS_SUFFIX)))


def partial_update(rows: DataFrame, level: str, mode: str, name: str = CONCEPT) -> DataFrame:
    """Long rows (.., mode, field, values) for rows that carry ``values``."""
    return rows.withColumn("mode", F.lit(mode)).withColumn("field", F.explode(update_field_names(name, level)))


def identified(records: DataFrame) -> DataFrame:
    """Concept page records with their volume id, page id and texts; page_id is NULL for a bad page name."""
    return records.select(
        ids.concept_volume_id(F.col("collectionName"), F.col("documentId")).alias("volume_id"),
        ids.concept_page_id(F.col("pageId")).alias("page_id"),
        F.col("pageId").alias("source_page"),
        concept_texts(F.col("concepts")).alias("values"),
    )


def bad_page_names(records: DataFrame) -> DataFrame:
    """Quarantine: records whose page name holds no page number."""
    return identified(records).filter(F.col("page_id").isNull()).select("volume_id", "source_page")


def _commands(steps: list[tuple[Column, str, str]]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"),
                target.alias("target_id"),
                F.lit(mode).alias("mode"),
                update_field_names(CONCEPT, level).alias("fields"),
            )
            for i, (target, mode, level) in enumerate(steps)
        ]
    )


def page_updates(records: DataFrame) -> DataFrame:
    """Four commands per page with concepts: page remove, page add, volume remove, volume add."""
    found = identified(records).filter(F.col("page_id").isNotNull() & (F.size("values") > 0))
    page = F.concat(F.col("volume_id"), F.lit("."), F.col("page_id"))
    volume = F.col("volume_id")
    steps = _commands([(page, "remove", "page"), (page, "add", "page"), (volume, "remove", "volume"), (volume, "add", "volume")])
    return unfold(found, steps, "c", "volume_id", "page_id", "values").select(
        "volume_id", "page_id", "c.ord", "c.target_id", "c.mode", "c.fields", "values"
    )


def volume_updates(records: DataFrame) -> DataFrame:
    """Two commands per volume record that has pages, with all pages' concepts, even when there are none."""
    texts = F.flatten(F.transform("pages", lambda p: concept_texts(p["concepts"])))
    steps = _commands([(F.col("volId"), "remove", "volume"), (F.col("volId"), "add", "volume")])
    found = records.filter(F.col("pages").isNotNull())
    return (
        unfold(found, steps, "c", F.col("volId").alias("volume_id"), texts.alias("values"))
        .select("volume_id", "c.ord", "c.target_id", "c.mode", "c.fields", "values")
    )


def update_json(updates: DataFrame) -> DataFrame:
    """The command text ``{id, field: {mode: [..]}, ..}`` of each update."""
    change = F.concat(F.lit("{"), jsontext.quoted(F.col("mode")), F.lit(":"), F.to_json("values"), F.lit("}"))
    parts = F.transform("fields", lambda f: F.concat(F.lit('"'), f, F.lit('":'), F.col("_change")))
    head = jsontext.joined(F.struct(F.col("target_id").alias("id")))
    doc = jsontext.braces(F.concat_ws(",", head, parts))
    return updates.withColumn("_change", change).withColumn("json", doc).drop("_change")


def last_updates(updates: DataFrame, order: str) -> DataFrame:
    """(id, field, value, n): of (id, field, value, n, order) the last for each value."""
    return updates.groupBy("id", "field", "value").agg(F.max_by("n", order).alias("n"))


def apply_updates(store: DataFrame, updates: DataFrame, order: str) -> DataFrame:
    """The stored values after all remove-then-add pairs, as (id, field, value, n).

    ``store`` is (id, field, value, n) and ``updates`` (id, field, value, n, order). Each pair deletes every
    occurrence of its values and appends them again, so a value's last update sets how often it is stored;
    values no update names keep their number. Rows are spread by value, never gathered per document. For a store that
    is updated again and again, a ``KeyedStore`` takes the ``last_updates`` of each round without moving what is stored.
    """
    last = last_updates(updates, order).withColumnRenamed("n", "n_new")
    return (
        store.select("id", "field", "value", F.col("n").alias("n_old"))
        .join(last, ["id", "field", "value"], "full_outer")
        .select("id", "field", "value", F.coalesce("n_new", "n_old").alias("n"))
    )


def value_counts(updates: DataFrame, order: list[str]) -> DataFrame:
    """Add commands as (id, field, value, n, order..): how often each update names a value."""
    added = updates.filter(F.col("mode") == "add")
    named = unfold(added, "fields", "field", F.col("target_id").alias("id"), *order, "values")
    return (
        unfold(named, "values", "value", "id", "field", *order)
        .groupBy("id", "field", "value", *order)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pages_without_concepts(records: DataFrame) -> DataFrame:
    return identified(records).filter(F.size("values") == 0).select("volume_id", "source_page")
