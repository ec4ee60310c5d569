"""Text fields of a page, and search documents of volumes and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens import settings as S
from quirelens.functions import jsontext
from quirelens.operators import fields as M
from quirelens.operators.explode import explode_pages, token_arrays
from quirelens.operators.pos import embedded_map, pos_pair, resolve_pair
from quirelens.operators.terms import term_arrays
from quirelens.settings import EMBED_MAX_ROWS


def _names(pair: Column) -> Column:
    """The fields a pair (lang, upos) goes to: ``<lang>_<upos>`` where there is one, and ``<lang>``."""
    pos = F.when(pair["upos"].isNotNull(), F.concat(pair["lang"], F.lit("_"), pair["upos"]))
    return F.struct(pos.alias("pos"), pair["lang"].alias("lang"))


def _paired_terms(pages: DataFrame, pos_map: DataFrame, max_embed: int) -> DataFrame:
    """Add ``paired``: one struct(names, term) per term and tag, see ``_names``; empty for a page without a language."""
    none = F.array().cast("array<struct<names: struct<pos: string, lang: string>, term: string>>")
    tree = embedded_map(pos_map, max_embed)
    if tree is None:
        # A map too large to embed: resolve the tags by join and gather each row again, told apart by its number. The
        # row itself travels with its first tag only.
        numbered = pages.select(F.monotonically_increasing_id().alias("_row"), "langs", "terms", F.struct(*pages.columns).alias("_own"))
        split = numbered.select("_row", "langs", "_own", F.posexplode_outer("terms").alias("_t", "t"))
        tagged = split.select("_row", "langs", "_own", "_t", F.col("t.term").alias("term"), F.posexplode_outer("t.pos_tags").alias("_g", "tag"))
        first = (F.coalesce("_t", F.lit(0)) == 0) & (F.coalesce("_g", F.lit(0)) == 0)
        found = pos_pair(tagged.withColumn("_own", F.when(first, F.col("_own"))), pos_map, max_embed)
        pair = F.when(F.col("lang").isNotNull() & F.col("tag").isNotNull(), F.struct("_t", "_g", "lang", "upos", "term"))
        gathered = found.groupBy("_row").agg(F.first("_own", ignorenulls=True).alias("_own"), F.sort_array(F.collect_list(pair)).alias("_pairs"))
        paired = F.transform("_pairs", lambda p: F.struct(_names(p).alias("names"), p["term"].alias("term")))
        return gathered.select("_own.*", paired.alias("paired"))
    # the names are made once for each different tag of a page, not for each of its terms
    tags = F.array_distinct(F.flatten("terms.pos_tags"))
    resolved = F.map_from_entries(
        F.transform(tags, lambda t: F.struct(t, F.get(F.transform(F.array(resolve_pair(F.col("langs"), t, tree)), _names), F.lit(0))))
    )

    def pairs(names: Column) -> Column:
        return F.flatten(
            F.transform("terms", lambda t: F.transform(t["pos_tags"], lambda g: F.struct(F.try_element_at(names, g).alias("names"), t["term"].alias("term"))))
        )

    # bound once: a map referred to inside the transform alone would be made again for each tag
    paired = F.get(F.transform(F.array(resolved), pairs), F.lit(0))
    return pages.withColumn("paired", F.when(F.size("langs") > 0, paired).otherwise(none))


def _text_fields(paired: Column) -> Column:
    """``<lang>_<upos>``, ``<lang>`` and all-language fields; a term with k tags counts k times."""

    def entry(name: Column, values: Column) -> Column:
        return F.struct(
            F.concat(name, F.lit(S.TOKENS_SUFFIX)).alias("field"), F.lit("multi").alias("kind"), values.alias("values")
        )

    def by(level: str) -> Column:
        names = F.filter(F.array_distinct(paired["names"][level]), lambda n: n.isNotNull())
        return F.transform(names, lambda n: entry(n, F.filter(paired, lambda p: p["names"][level] == n)["term"]))

    everything = F.array(entry(F.lit(S.ALL_LANGS), paired["term"]))
    return F.when(F.size(paired) > 0, F.concat(by("pos"), by("lang"), everything)).otherwise(
        F.array().cast(M.FIELDS_DDL)
    )


def text_fields(pages: DataFrame, pos_map: DataFrame, max_embed: int = EMBED_MAX_ROWS) -> DataFrame:
    """Add ``text_fields`` to pages that carry a ``terms`` array."""
    return _paired_terms(pages, pos_map, max_embed).withColumn("text_fields", _text_fields(F.col("paired"))).drop("paired")


def no_text_flag(terms: Column) -> Column:
    """The flag field of a page left with no terms at all."""
    flag = F.array(F.struct(F.lit(S.NO_TEXT_FIELD).alias("field"), F.lit("flag").alias("kind"), F.array(F.lit("true")).alias("values")))
    return F.when(F.size(terms) == 0, flag).otherwise(F.array().cast(M.FIELDS_DDL))


def add_command(doc_members: Column, within: int = S.COMMIT_WITHIN) -> Column:
    return F.concat(F.lit(f'{{"add":{{"commitWithin":{within},"doc":{{'), doc_members, F.lit("}}}"))


def volume_documents(volumes: DataFrame, version: str = "2") -> DataFrame:
    """One add command per volume that has metadata; ``metadata`` is a VARIANT."""
    known = volumes.filter(F.col("metadata").isNotNull()).select("volume_id", "metadata")
    typed, entries = M.typed_metadata(known, version)
    doc = jsontext.listed(jsontext.joined(F.struct(F.col("volume_id").alias("id"))), M.members(entries, M.VOLUME))
    return typed.select("volume_id", F.col("volume_id").alias("doc_id"), add_command(doc).alias("json"))


def page_documents(
    volumes: DataFrame,
    pos_map: DataFrame,
    dictionary: DataFrame | None = None,
    version: str = "2",
    tokenize: bool = True,
) -> DataFrame:
    """One add command per indexable page.

    A volume's metadata members are made once, before its pages are unfolded, and travel with them.
    """
    typed, entries = M.typed_metadata(volumes, version)
    made = typed.withColumn("meta_members", M.members(entries, M.PAGE))
    pages = token_arrays(explode_pages(made, keep=("meta_members",)))
    texts = text_fields(term_arrays(pages, dictionary, tokenize), pos_map)
    by_field = F.map_from_entries(
        F.transform("text_fields", lambda f: F.struct(f["field"].alias("field"), f["values"].alias("values")))
    )
    own = F.struct(
        F.col("page_id").alias("id"),
        F.col("volume_id").alias(S.VOLUME_ID_FIELD),
        F.when(F.size("terms") == 0, F.lit(True)).alias(S.NO_TEXT_FIELD),
    )
    doc = jsontext.listed(jsontext.joined(own, by_field), F.col("meta_members"))
    return texts.select("volume_id", F.col("page_id").alias("doc_id"), add_command(doc).alias("json"))
