"""Identifier and path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelens.settings import CONCEPT_PAGE_PATTERN, ID_PREFIX_PATTERN


def volume_id(record_id: Column, prefix: str = ID_PREFIX_PATTERN) -> Column:
    """Record id without the first dataset prefix."""
    return F.regexp_replace(record_id, F.lit(f"(?s)^(.*?){prefix}"), F.lit("$1"))


def page_id(volume: Column, index: Column) -> Column:
    return F.format_string("%s.page-%06d", volume, index)


def _after_first_dot(c: Column) -> Column:
    return F.when(F.contains(c, F.lit(".")), F.substr(c, F.position(F.lit("."), c) + 1)).otherwise(c)


def os_friendly(c: Column) -> Column:
    """``/`` to ``=``, ``:`` to ``+`` everywhere; dots after the first one to ``,``."""
    mapped = F.translate(c, "/:", "=+")
    at = F.position(F.lit("."), mapped)
    return F.when(at == 0, mapped).otherwise(
        F.concat(F.substr(mapped, F.lit(1), at), F.translate(F.substr(mapped, at + 1), ".", ","))
    )


def pairtree_to_id(path: Column) -> Column:
    base = F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.json\.bz2$", "")
    return F.translate(base, "=+,", "/:.")


def id_to_stubby(c: Column) -> Column:
    """``inst/stub/inst.rest.json.bz2`` where the stub is every third character of the file-safe rest."""
    inst = F.substring_index(c, ".", 1)
    safe = F.translate(_after_first_dot(c), "/:.", "=+,")
    starts = F.sequence(F.lit(1), F.greatest(F.length(safe), F.lit(1)), F.lit(3))
    stub = F.array_join(F.transform(starts, lambda p: F.substr(safe, p, F.lit(1))), "")
    return F.concat(inst, F.lit("/"), stub, F.lit("/"), inst, F.lit("."), safe, F.lit(".json.bz2"))


def concept_volume_id(collection: Column, document: Column) -> Column:
    return F.when(F.endswith(collection, F.lit(":")), F.concat(collection, F.lit("/"), document)).otherwise(document)


def concept_page_id(page: Column) -> Column:
    """``page-NNNNNN`` from a name ending in six digits and ``.txt``; NULL when it does not match."""
    digits = F.nullif(F.regexp_extract(page, CONCEPT_PAGE_PATTERN, 1), F.lit(""))
    return F.concat(F.lit("page-"), digits)


def safe_key(c: Column) -> Column:
    """A key a document store accepts: no dots, no dollar signs."""
    return F.replace(F.replace(c, F.lit("."), F.lit("<PERIOD>")), F.lit("$"), F.lit("<DOLLAR>"))


def output_name(list_path: Column, prefix: str) -> Column:
    """Result directory for a list file: directories dropped, name cut at the first dot."""
    root = F.regexp_replace(F.regexp_replace(list_path, r"^.*/", ""), r"\..*$", "")
    return F.concat(F.lit(prefix + "-"), root, F.lit("-out"))
