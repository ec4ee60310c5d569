"""Metadata that is not as it should be: what stands where, counted by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens import settings as S
from quirelens.operators.explode import unfold

ANOMALY_DDL = "struct<path: string, reason: string, found: string>"
MISSING, NOT_TEXT, NOT_LIST, NOT_OBJECT = "missing", "not text", "not a list", "not an object"
NOT_MULTI, NOT_ENTITY, NO_ID = "neither text nor list", "neither object nor list", "no id"
NOT_WHOLE, EMPTY, VALUE, LENGTH = "not a whole number", "empty", "unexpected value", "unexpected length"


def value_type(value: Column) -> Column:
    """The JSON type of a VARIANT without its inside: STRING, BIGINT, DECIMAL, ARRAY, OBJECT, ..; VOID for null, NULL for nothing."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _at(meta: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(meta, f"$.{path}", kind)


def _kind(meta: Column, path: str) -> Column:
    """The type at a path; NULL where nothing or null stands."""
    found = value_type(_at(meta, path))
    return F.when(found != "VOID", found)


def _anomaly(path: str, reason: str, found: Column) -> Column:
    return F.struct(F.lit(path).alias("path"), F.lit(reason).alias("reason"), found.alias("found"))


def _unless(meta: Column, path: str, fits: list[str], reason: str) -> Column:
    kind = _kind(meta, path)
    return F.when(~kind.isin(fits), _anomaly(path, reason, kind))


def _inside(meta: Column, path: str, fits: str, reason: str) -> Column:
    """For a list: the type of the first member that does not fit."""
    wrong = F.filter(F.transform(_at(meta, path, "array<variant>"), value_type), lambda k: k != fits)
    return F.when(F.size(wrong) > 0, _anomaly(f"{path}[]", reason, F.get(wrong, F.lit(0))))


def _whole_number(meta: Column, name: str) -> list[Column]:
    kind, text = _kind(meta, name), _at(meta, name, "string")
    empty = (kind == "STRING") & (text == "")
    return [
        F.when(empty, _anomaly(name, EMPTY, kind)),
        F.when(~empty & ~F.rlike(text, F.lit(r"^[+-]?[0-9]+$")), _anomaly(name, NOT_WHOLE, kind)),
    ]


def _entity(meta: Column, name: str) -> list[Column]:
    kind = _kind(meta, name)
    without = F.filter(_at(meta, name, "array<map<string, variant>>"), lambda e: e.isNotNull() & F.try_element_at(e, F.lit("id")).isNull())
    return [
        _unless(meta, name, ["OBJECT", "ARRAY"], NOT_ENTITY),
        F.when((kind == "OBJECT") & _at(meta, f"{name}.id", "string").isNull(), _anomaly(name, NO_ID, kind)),
        _inside(meta, name, "OBJECT", NOT_OBJECT),
        F.when(F.size(without) > 0, _anomaly(f"{name}[]", NO_ID, F.lit("OBJECT"))),
    ]


def _listed(meta: Column, name: str, lengths: list[int], first: Column) -> list[Column]:
    """A list that must be there, of certain lengths, whose first member must be as ``first`` says."""
    kind = _kind(meta, name)
    return [
        F.when(kind.isNull(), _anomaly(name, MISSING, F.lit(None).cast("string"))),
        _unless(meta, name, ["ARRAY"], NOT_LIST),
        F.when(~F.size(_at(meta, name, "array<variant>")).isin(lengths), _anomaly(name, LENGTH, kind)),
        F.when(~first, _anomaly(f"{name}[0]", VALUE, _kind(meta, f"{name}[0]"))),
    ]


def anomalies(meta: Column) -> Column:
    """``array<struct<path, reason, found>>``: everything in a version 2 record's metadata that cannot be used as it stands."""
    feed = _at(meta, "type[0]", "string") == S.FEED_ITEM_TYPE
    record = F.rlike(_at(meta, "mainEntityOfPage[0]", "string"), F.lit(S.CATALOG_RECORD_PATTERN))
    source = "sourceInstitution"
    checks = [
        *[_unless(meta, n, ["STRING"], NOT_TEXT) for n in (*S.V2_STRINGS, *S.V2_URIS)],
        *[c for n in S.V2_INTS for c in _whole_number(meta, n)],
        *[c for n in (*S.V2_MULTI, *S.V2_MULTI_URIS) for c in (_unless(meta, n, ["STRING", "ARRAY"], NOT_MULTI), _inside(meta, n, "STRING", NOT_TEXT))],
        *[c for n in S.V2_ENTITIES for c in _entity(meta, n)],
        *_listed(meta, "type", [2], feed),
        F.when(_kind(meta, source).isNull(), _anomaly(source, MISSING, F.lit(None).cast("string"))),
        _unless(meta, source, ["OBJECT"], NOT_OBJECT),
        F.when(_at(meta, f"{source}.type", "string") != S.ORGANIZATION_TYPE, _anomaly(f"{source}.type", VALUE, _kind(meta, f"{source}.type"))),
        *_listed(meta, "mainEntityOfPage", [1, 3], record),
    ]
    none = F.array(_anomaly("metadata", MISSING, F.lit(None).cast("string")))
    return F.when(meta.isNull(), none).otherwise(F.filter(F.array(*checks), lambda a: a.isNotNull()))


def anomaly_report(records: DataFrame, group: str, example: str = "volume_id") -> DataFrame:
    """(group, path, reason, found, n, example): how often each anomaly occurs in a group, and its first record.

    ``metadata`` is a VARIANT, NULL where a record has none. Anomalies are counted in tasks before anything is shuffled.
    """
    found = unfold(records, anomalies(F.col("metadata")), "a", group, example)
    counted = found.groupBy(group, F.col("a.path").alias("path"), F.col("a.reason").alias("reason"), F.col("a.found").alias("found"))
    return counted.agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("example"))


def type_report(records: DataFrame, group: str) -> DataFrame:
    """(group, member, found, n): which types the members of metadata have in a group."""
    named = F.map_entries(F.try_variant_get("metadata", "$", "map<string, variant>"))
    types = F.transform(named, lambda e: F.struct(e["key"].alias("member"), F.coalesce(value_type(e["value"]), F.lit("VOID")).alias("found")))
    return unfold(records, types, "t", group).groupBy(group, "t.member", "t.found").agg(F.count(F.lit(1)).alias("n"))
