"""Records made safe for a document store, and the keyed replace of stored records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StructType

from quirelens.functions.ids import safe_key
from quirelens.operators.lookup import left_lookup
from quirelens.settings import CHAR_MAPS, TOKEN_MAP, ZONES


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _is_unsafe(key: Column) -> Column:
    return F.contains(key, F.lit(".")) | F.contains(key, F.lit("$"))


def _rewritten(entries: Column) -> Column:
    """Entries with safe keys. Of keys that become equal, a rewritten one wins, and among those the later."""
    renamed = F.transform(
        F.concat(F.filter(entries, lambda e: ~_is_unsafe(e["key"])), F.filter(entries, lambda e: _is_unsafe(e["key"]))),
        lambda e: F.struct(safe_key(e["key"]).alias("key"), e["value"].alias("value")),
    )

    def last_of_each(keyed: Column) -> Column:
        keys = F.transform(keyed, lambda e: e["key"])
        last = F.filter(keyed, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
        # The pairwise check only runs on a map that has such a clash.
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), keyed).otherwise(last)

    return F.map_from_entries(_bound(renamed, last_of_each))


def _has_unsafe(names: Column) -> Column:
    """Whether any of the names of a map is unsafe: they are looked through as one text, not one by one."""
    return _bound(F.array_join(names, ""), _is_unsafe)


def safe_counts(counts: Column, values: Column | None = None) -> Column:
    """A map with safe keys; one without unsafe keys stays as it is.

    ``counts`` is a stored map or a lambda's variable, which costs nothing to refer to again. ``values`` is the same
    map with other values, where those change too.
    """
    made = counts if values is None else values

    def renamed(names: Column) -> Column:
        clash = F.size(F.array_distinct(names)) < F.size(names)
        return F.when(clash, _rewritten(F.map_entries(made))).otherwise(F.map_from_arrays(names, F.map_values(made)))

    names = F.transform(F.map_keys(counts), safe_key)
    return F.when(_has_unsafe(F.map_keys(counts)), _bound(names, renamed)).otherwise(made)


def safe_zone(zone: Column, kind: StructType) -> Column:
    """A zone with safe keys and counts as whole numbers; ``kind`` is its type."""

    def whole(counts: Column, of: MapType) -> Column | None:
        # the parser leaves counts as text; one that is not a whole number is stored as null, its key stays
        return None if of.valueType == IntegerType() else F.transform_values(counts, lambda _, n: n.try_cast("int"))

    of_tags = kind[TOKEN_MAP].dataType.valueType
    safe_tags = F.transform_values(zone[TOKEN_MAP], lambda _, tags: safe_counts(tags, whole(tags, of_tags)))
    if of_tags.valueType == IntegerType():
        # whole already: new maps are made only where a page has a tag to rewrite
        tags = F.flatten(F.filter(F.transform(F.map_values(zone[TOKEN_MAP]), F.map_keys), lambda names: names.isNotNull()))
        safe_tags = F.when(_has_unsafe(tags), safe_tags).otherwise(zone[TOKEN_MAP])
    chars = [safe_counts(zone[m], whole(zone[m], kind[m].dataType)).alias(m) for m in CHAR_MAPS]
    return F.when(zone.isNotNull(), F.struct(safe_counts(zone[TOKEN_MAP], safe_tags).alias(TOKEN_MAP), *chars))


def safe_zone_maps(pages: DataFrame) -> DataFrame:
    """Safe keys in the three count maps of the three zones, and in the tag maps of the tokens."""
    return pages.withColumns({z: safe_zone(F.col(z), pages.schema[z].dataType) for z in ZONES})


def docstore_rows(volumes: DataFrame) -> DataFrame:
    return volumes.withColumnRenamed("id", "_id")


def last_incoming(incoming: DataFrame, order: str | None = None) -> DataFrame:
    """(_id, doc): of several incoming documents of one key the last by ``order``, or the greatest."""
    return incoming.groupBy("_id").agg(F.max_by("doc", order if order else "doc").alias("doc"))


def replace_only(existing: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Stored (_id, doc) with the incoming document where one has the same key; unknown keys are not added.

    Several incoming documents of one key are first reduced to the last by ``order`` (or the greatest).
    """
    last = last_incoming(incoming, order).withColumnRenamed("doc", "doc_new")
    return left_lookup(existing, last, ["_id"]).select("_id", F.coalesce("doc_new", "doc").alias("doc"))
