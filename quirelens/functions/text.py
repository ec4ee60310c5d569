"""Word-break functions over token strings and over a page's token array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelens.settings import TOKEN_PATTERN


def words(c: Column, lower: bool = False) -> Column:
    """The word-break terms of a string, in order."""
    found = F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(found, F.lower) if lower else found


def split_terms(tokens: Column, lower: bool = False, tokenize: bool = True) -> Column:
    """``array<token, pos_tags>`` to ``array<term, pos_tags>``: every term keeps its token's tags."""
    if not tokenize:
        return F.transform(tokens, lambda t: F.struct(t["token"].alias("term"), t["pos_tags"].alias("pos_tags")))
    return F.flatten(
        F.transform(
            tokens,
            lambda t: F.transform(
                words(t["token"], lower), lambda w: F.struct(w.alias("term"), t["pos_tags"].alias("pos_tags"))
            ),
        )
    )


def fold_terms(terms: Column) -> Column:
    """``array<term, pos_tags>`` broken again into lowercased terms."""
    return F.flatten(
        F.transform(
            terms,
            lambda t: F.transform(
                words(t["term"], True), lambda w: F.struct(w.alias("term"), t["pos_tags"].alias("pos_tags"))
            ),
        )
    )
