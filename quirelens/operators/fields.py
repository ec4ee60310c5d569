"""Bibliographic metadata flattened into typed search fields.

Metadata arrives as a VARIANT column. It is first read into typed columns, once per record
(``typed_metadata``); fields are then named at volume or page level, either as long rows
(``doc_fields``) or as the members of a JSON document (``members``). All of it is projection: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens import settings as S
from quirelens.functions import jsontext
from quirelens.operators.explode import unfold

VOLUME, PAGE = "volume", "page"
FIELDS_DDL = "array<struct<field: string, kind: string, values: array<string>>>"


@dataclass(frozen=True)
class Entry:
    """One metadata value: ``string`` and ``uri`` hold a string, ``int`` an integer, ``multi`` and ``uris``
    an array of strings, ``multi_map`` and ``string_map`` such values by name."""

    name: str
    mode: str
    value: Column


# Suffixes a value is stored under, by level and mode, with the kind of the field.
SUFFIXES = {
    VOLUME: {
        "string": [(S.VOLUME_TEXT_SUFFIX, "single"), (S.VOLUME_FACET_SUFFIX, "single")],
        "uri": [(S.VOLUME_FACET_SUFFIX, "single")],
        "int": [(S.INT_SUFFIX, "int")],
        "multi": [(S.VOLUME_TEXT_SUFFIX, "multi"), (S.VOLUME_FACETS_SUFFIX, "multi")],
        "uris": [(S.VOLUME_FACETS_SUFFIX, "multi")],
    },
    PAGE: {
        "string": [(S.PAGE_TEXT_SUFFIX, "single"), (S.PAGE_FACET_SUFFIX, "single")],
        "uri": [(S.PAGE_FACET_SUFFIX, "single")],
        "int": [(S.INT_SUFFIX, "int")],
        "multi": [(S.PAGE_TEXT_SUFFIX, "multi"), (S.PAGE_FACETS_SUFFIX, "multi")],
        "uris": [(S.PAGE_FACETS_SUFFIX, "multi")],
    },
}


def parse_metadata(volumes: DataFrame) -> DataFrame:
    """Metadata text to VARIANT; unparsable text becomes NULL."""
    return volumes.withColumn("metadata", F.try_parse_json("metadata"))


def _text(meta: Column, name: str) -> Column:
    return F.try_variant_get(meta, f"$.{name}", "string")


def _shape(meta: Column, name: str) -> Column:
    """The JSON type of a member: STRING, BIGINT, ARRAY<..>, OBJECT<..>, VOID; NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(meta, f"$.{name}", "variant"))


def _string_or_array(meta: Column, name: str) -> Column:
    shape = _shape(meta, name)
    return F.when(shape == "STRING", F.array(_text(meta, name))).when(
        F.startswith(shape, F.lit("ARRAY")), F.try_variant_get(meta, f"$.{name}", "array<string>")
    )


def _kept_uris(values: Column) -> Column:
    """Without blank-node identifiers; NULL when nothing is left."""
    kept = F.filter(values, lambda v: ~F.startswith(v, F.lit(S.DROPPED_URI_PREFIX)))
    return F.nullif(kept, F.array().cast("array<string>"))


def v2_strings(meta: Column) -> list[Entry]:
    return [Entry("htid" if n == "id" else n, "string", _text(meta, n)) for n in S.V2_STRINGS]


def v2_ints(meta: Column) -> list[Entry]:
    """Integers, truncated if fractional; integer text counts, other text stays a string, empty text is dropped."""
    entries = []
    for name in S.V2_INTS:
        shape, raw = _shape(meta, name), _text(meta, name)
        is_text = shape == "STRING"
        is_number = shape.isin("BIGINT", "DOUBLE") | F.startswith(shape, F.lit("DECIMAL"))
        plain = F.rlike(raw, F.lit(r"^[+-]?[0-9]+$"))
        whole = F.when(is_text & plain, raw.try_cast("int")).when(is_number, F.try_variant_get(meta, f"$.{name}", "int"))
        shown = F.coalesce(whole.cast("string"), F.when(is_text | is_number, F.nullif(raw, F.lit(""))))
        entries += [Entry(name, "int", whole), Entry(name, "string", shown)]
    return entries


def v2_uris(meta: Column) -> list[Entry]:
    return [Entry(n, "uri", _text(meta, n)) for n in S.V2_URIS]


def v2_multi(meta: Column) -> list[Entry]:
    return [Entry(n, "multi", _string_or_array(meta, n)) for n in S.V2_MULTI]


def v2_multi_uris(meta: Column) -> list[Entry]:
    return [Entry(n, "uris", _kept_uris(_string_or_array(meta, n))) for n in S.V2_MULTI_URIS]


def v2_entities(meta: Column) -> list[Entry]:
    """``<name>Id``, ``<name>Name``, ``<name>Type``; missing parts are dropped, so the arrays need not align.

    A single entity without an id gives nothing; in an array the other entities still count.
    """
    entries = []
    ddl = "struct<id: string, name: string, type: string>"
    for name in S.V2_ENTITIES:
        shape = _shape(meta, name)
        single = F.try_variant_get(meta, f"$.{name}", ddl)
        people = F.when(F.startswith(shape, F.lit("ARRAY")), F.try_variant_get(meta, f"$.{name}", f"array<{ddl}>")).when(
            F.startswith(shape, F.lit("OBJECT")) & single["id"].isNotNull(), F.array(single)
        )
        parts = {k: F.filter(people[k], lambda v: v.isNotNull()) for k in ("id", "name", "type")}
        entries += [
            Entry(name + "Id", "uris", _kept_uris(parts["id"])),
            Entry(name + "Name", "multi", F.nullif(parts["name"], F.array().cast("array<string>"))),
            Entry(name + "Type", "uris", _kept_uris(parts["type"])),
        ]
    return entries


def v2_bib_format(meta: Column) -> list[Entry]:
    feed = F.try_variant_get(meta, "$.type[0]", "string") == S.FEED_ITEM_TYPE
    return [Entry("bibliographicFormat", "string", F.when(feed, F.try_variant_get(meta, "$.type[1]", "string")))]


def v2_source_institution(meta: Column) -> list[Entry]:
    known = F.try_variant_get(meta, "$.sourceInstitution.type", "string") == S.ORGANIZATION_TYPE
    name = F.try_variant_get(meta, "$.sourceInstitution.name", "string")
    return [Entry("sourceInstitution", "string", F.when(known, name))]


def v2_catalog_record(meta: Column) -> list[Entry]:
    first = F.try_variant_get(meta, "$.mainEntityOfPage[0]", "string")
    found = F.when(F.rlike(first, F.lit(S.CATALOG_RECORD_PATTERN)), first)
    return [Entry("mainEntityOfPageCatalogRecord", "uri", found)]


V2_PARTS = [
    v2_strings, v2_ints, v2_uris, v2_multi, v2_multi_uris, v2_entities,
    v2_bib_format, v2_source_institution, v2_catalog_record,
]


def v15_strings(meta: Column, further: tuple[str, ...] = ()) -> list[Entry]:
    """The listed single strings, and further ones the caller names."""
    return [Entry(n, "string", _text(meta, n)) for n in [*S.V15_STRINGS, *further]]


def v15_multi(meta: Column) -> list[Entry]:
    return [Entry(n, "multi", F.try_variant_get(meta, f"$.{n}", "array<string>")) for n in S.V15_MULTI]


def v15_classification(meta: Column) -> list[Entry]:
    return [Entry(n + "_", "multi_map", F.try_variant_get(meta, f"$.{n}", "map<string, array<string>>")) for n in S.V15_MAPS]


V15_PARTS = [v15_strings, v15_multi, v15_classification]


def typed_metadata(records: DataFrame, version: str = "2", parts: list | None = None) -> tuple[DataFrame, list[Entry]]:
    """Records with one typed column per metadata value, in place of ``metadata``, and the entries they hold."""
    chosen = parts or (V2_PARTS if version == "2" else V15_PARTS)
    entries = [e for part in chosen for e in part(F.col("metadata"))]
    columns = {f"_m{i}": e.value for i, e in enumerate(entries)}
    typed = records.select(*[c for c in records.columns if c != "metadata"], *[v.alias(k) for k, v in columns.items()])
    return typed, [Entry(e.name, e.mode, F.col(f"_m{i}")) for i, e in enumerate(entries)]


def _prefix(level: str) -> str:
    return "volume" if level == PAGE else ""


def field_rows(entries: list[Entry], level: str) -> Column:
    """The fields of a record as ``array<struct<field, kind, values>>``."""
    fixed, named = [], []
    for e in entries:
        mode = e.mode.removesuffix("_map")
        for suffix, kind in SUFFIXES[level][mode]:

            def one(name: Column, value: Column, kind: str = kind, suffix: str = suffix) -> Column:
                values = value if kind == "multi" else F.array(value.cast("string"))
                field = F.concat(F.lit(_prefix(level) + e.name), name, F.lit(suffix))
                return F.struct(field.alias("field"), F.lit(kind).alias("kind"), values.alias("values"))

            if e.mode.endswith("_map"):
                named.append(_each(e.value, one))
            else:
                fixed.append(F.when(e.value.isNotNull(), one(F.lit(""), e.value)))
    none = F.array().cast(FIELDS_DDL)
    return F.concat(F.filter(F.array(*fixed), lambda f: f.isNotNull()) if fixed else none, *[F.coalesce(n, none) for n in named])


def _each(values: Column, one) -> Column:
    return F.transform(F.map_entries(values), lambda m: one(m["key"], m["value"]))


def members(entries: list[Entry], level: str) -> Column:
    """The fields of a record as JSON object members; missing values are left out."""
    fixed, named = [], []
    for e in entries:
        mode = e.mode.removesuffix("_map")
        for suffix, _ in SUFFIXES[level][mode]:
            if e.mode.endswith("_map"):
                named.append(_renamed(e.value, _prefix(level) + e.name, suffix))
            else:
                fixed.append(e.value.alias(_prefix(level) + e.name + suffix))
    return jsontext.joined(F.struct(*fixed), *named)


def _renamed(values: Column, prefix: str, suffix: str) -> Column:
    return F.transform_keys(values, lambda k, _: F.concat(F.lit(prefix), k, F.lit(suffix)))


def doc_fields(records: DataFrame, doc_id: str, fields: Column) -> DataFrame:
    """Long rows (doc_id, field, kind, values)."""
    return unfold(records, fields, "f", F.col(doc_id).alias("doc_id")).select("doc_id", "f.field", "f.kind", "f.values")
