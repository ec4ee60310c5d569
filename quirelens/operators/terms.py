"""Terms of page tokens: word-break, case folding and dictionary filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.functions import text
from quirelens.operators.explode import unfold
from quirelens.operators.lookup import fits_broadcast, flag_members
from quirelens.settings import EMBED_MAX_ROWS


def terms(page_tokens: DataFrame, lower: bool = False, tokenize: bool = True) -> DataFrame:
    """One row per term of a token; the token's tags go to each of its terms."""
    if not tokenize:
        return page_tokens.withColumnRenamed("token", "term")
    kept = [c for c in page_tokens.columns if c != "token"]
    found = unfold(page_tokens, text.words(F.col("token")), "term", *kept)
    return found.withColumn("term", F.lower("term")) if lower else found


def fold_terms(page_terms: DataFrame) -> DataFrame:
    """Each term broken again by the standard rule and lowercased."""
    kept = [c for c in page_terms.columns if c != "term"]
    return unfold(page_terms, text.words(F.col("term")), "term", *kept).withColumn("term", F.lower("term"))


def _checked(page_terms: DataFrame, dictionary: DataFrame, broken: bool, small: bool | None) -> DataFrame:
    """Lowercased sub-terms with ``_kept``; a row without a term or without sub-terms stays as a row not kept."""
    small = fits_broadcast(dictionary) if small is None else small
    whole = flag_members(page_terms, dictionary, "term", "_whole", small)
    if broken:
        # A word-break term broken again is itself.
        parts = whole.withColumn("term", F.lower("term"))
    else:
        others = [c for c in whole.columns if c != "term"]
        parts = whole.select(*others, F.explode_outer(text.words(F.col("term"))).alias("term")).withColumn("term", F.lower("term"))
    checked = flag_members(parts, dictionary, "term", "_part", small)
    kept = F.col("term").isNotNull() & (F.col("_whole") | F.col("_part"))
    return checked.withColumn("_kept", kept).select(*page_terms.columns, "_kept")


def dictionary_filter(
    page_terms: DataFrame, dictionary: DataFrame, broken: bool = False, small: bool | None = None
) -> DataFrame:
    """Lowercased sub-terms: all of them when the term itself is a dictionary word, else the ones that are.

    ``broken`` says that the terms are word-break terms already. ``small`` is the answer of
    ``fits_broadcast`` for the dictionary, where the caller has it.
    """
    return _checked(page_terms, dictionary, broken, small).filter("_kept").drop("_kept")


def page_terms(page_tokens: DataFrame, dictionary: DataFrame | None = None, tokenize: bool = True) -> DataFrame:
    """The terms indexed for a page: dictionary-filtered when a dictionary is given, else case-folded."""
    found = terms(page_tokens, tokenize=tokenize)
    if dictionary is not None:
        return dictionary_filter(found, dictionary, tokenize)
    return found.withColumn("term", F.lower("term")) if tokenize else fold_terms(found)


def _kept_terms(split: Column, words: list[str], broken: bool) -> Column:
    """``_checked`` inside the array: the lowercased sub-terms that stay, in order; ``words`` is a constant of the plan."""

    def known(term: Column) -> Column:
        return term.isin(words) if words else F.lit(False)

    def low(term: Column, tags: Column) -> Column:
        return F.struct(F.lower(term).alias("term"), tags.alias("pos_tags"))

    if broken:
        kept = F.filter(split, lambda t: known(t["term"]) | known(F.lower(t["term"])))
        return F.transform(kept, lambda t: low(t["term"], t["pos_tags"]))

    def parts(t: Column) -> Column:
        own = F.sort_array(F.transform(text.words(t["term"]), lambda w: low(w, t["pos_tags"])))
        return F.when(known(t["term"]), own).otherwise(F.filter(own, lambda p: known(p["term"])))

    return F.flatten(F.transform(split, parts))


def term_arrays(
    pages: DataFrame, dictionary: DataFrame | None = None, tokenize: bool = True, max_embed: int = EMBED_MAX_ROWS
) -> DataFrame:
    """Pages with a ``terms`` array in place of ``tokens``.

    Without a dictionary this is a projection, and so it is with one of at most ``max_embed`` words, which becomes a
    constant of the plan. With a larger one, the terms are looked up as rows and gathered again in the same pass; a group is one row of ``pages``, told apart by its number, so pages with one
    id stay apart. Pages left without terms stay. The page's other columns travel with its first term only.
    """
    others = [c for c in pages.columns if c != "tokens"]
    if dictionary is None:
        folded = text.split_terms(F.col("tokens"), lower=True) if tokenize else text.fold_terms(text.split_terms(F.col("tokens"), tokenize=False))
        return pages.select(*others, folded.alias("terms"))
    words = [r["word"] for r in dictionary.select("word").filter(F.col("word").isNotNull()).distinct().limit(max_embed + 1).collect()]
    if len(words) <= max_embed:
        return pages.select(*others, _kept_terms(text.split_terms(F.col("tokens"), tokenize=tokenize), words, tokenize).alias("terms"))
    numbered = pages.select(F.monotonically_increasing_id().alias("_row"), F.struct(*others).alias("_own"), "tokens")
    split = numbered.select("_row", "_own", F.posexplode_outer(text.split_terms(F.col("tokens"), tokenize=tokenize)).alias("_t", "t"))
    rows = split.select("_row", "_t", F.when(F.coalesce("_t", F.lit(0)) == 0, F.col("_own")).alias("_own"), "t.term", "t.pos_tags")
    kept = F.sort_array(F.collect_list(F.when(F.col("_kept"), F.struct("_t", "term", "pos_tags"))))
    gathered = _checked(rows, dictionary, tokenize, None).groupBy("_row").agg(F.first("_own", ignorenulls=True).alias("_own"), kept.alias("_terms"))
    found = F.transform("_terms", lambda t: F.struct(t["term"].alias("term"), t["pos_tags"].alias("pos_tags")))
    return gathered.select("_own.*", found.alias("terms"))


def page_texts(pages: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(page_id, text, dictionary_text): space-joined lowercased terms of a page, all and only dictionary words; ``tokens`` in.

    Both come out of one pass: terms are flagged as rows and each page gathered once. ``dictionary_text`` is NULL for a
    page without dictionary words.
    """
    lowered = pages.select("page_id", F.monotonically_increasing_id().alias("_row"), text.split_terms(F.col("tokens"), lower=True).alias("terms"))
    rows = lowered.select("page_id", "_row", F.explode_outer("terms.term").alias("term"))
    known = F.sort_array(F.collect_list(F.when(F.col("_known"), F.col("term"))))
    gathered = flag_members(rows, dictionary, "term", "_known").groupBy("_row").agg(
        F.first("page_id").alias("page_id"), F.sort_array(F.collect_list("term")).alias("all"), known.alias("known")
    )
    return gathered.select(
        "page_id", F.array_join("all", " ").alias("text"), F.when(F.size("known") > 0, F.array_join("known", " ")).alias("dictionary_text")
    )
