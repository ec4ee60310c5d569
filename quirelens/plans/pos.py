"""Queries: part-of-speech mapping and language labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelens.operators import counts
from quirelens.operators import explode as X
from quirelens.operators import pos as P
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query


def tags(spark, d, version="2"):
    rows = X.explode_pos(X.explode_tokens(X.explode_pages(T.volumes(spark, d, version))))
    unknown = F.when((F.col("tag") == "QQ") & (F.length("token") > 8), F.lit("UKN")).otherwise(F.col("tag"))
    return rows.select("page_id", "langs", F.get("langs", F.lit(0)).alias("lang"), "token", "tag", unknown.alias("tag_ukn"))


def _counted(rows, *keys):
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


TAGS = Q.tokens() + Q.POS_MAP
MERGED = """, merged AS (SELECT tag, arg_max(upos, lang) AS upos FROM pos_map GROUP BY tag),
 ukn AS (SELECT plang AS lang, CASE WHEN tag = 'QQ' AND length(token) > 8 THEN 'UKN' ELSE tag END AS tag FROM tagged)"""
# Pages of version 1.5: [lang, en], [en], or none.
PAIRED = """, pairs AS (SELECT page_id, CASE WHEN plang IS NULL THEN '' WHEN lang = 'en' THEN 'en' ELSE lang || ',en' END AS langs, plang, tag FROM tagged),
 paired AS (SELECT page_id, langs, p.tag, CASE WHEN a.upos IS NOT NULL THEN plang WHEN b.upos IS NOT NULL AND plang IS NOT NULL THEN 'en' ELSE plang END AS lang,
  CASE WHEN plang IS NULL THEN NULL ELSE coalesce(a.upos, b.upos, CASE WHEN plang IN (SELECT lang FROM pos_map) THEN 'X' END) END AS upos
  FROM pairs p LEFT JOIN pos_map a ON a.lang = plang AND a.tag = p.tag LEFT JOIN pos_map b ON b.lang = 'en' AND b.tag = p.tag)"""


@query("pos_lookup", TAGS + " SELECT plang AS lang, t.tag, upos, count(*) AS n FROM tagged t LEFT JOIN pos_map m ON m.lang = plang AND m.tag = t.tag GROUP BY ALL")
def pos_lookup(spark, d):
    rows = tags(spark, d).select("lang", "tag")
    return _counted(P.pos_lookup(rows, T.pos_map(spark, d)), "lang", "tag", "upos")


@query(
    "pos_lookup_checked",
    TAGS + """ SELECT plang AS lang, t.tag, CASE WHEN plang IS NULL OR plang NOT IN (SELECT lang FROM pos_map) THEN '' ELSE coalesce(upos, 'X') END AS upos, count(*) AS n
 FROM tagged t LEFT JOIN pos_map m ON m.lang = plang AND m.tag = t.tag GROUP BY ALL""",
)
def pos_lookup_checked(spark, d):
    rows = tags(spark, d).select("lang", "tag")
    return _counted(P.pos_lookup_checked(rows, T.pos_map(spark, d)), "lang", "tag", "upos")


@query("pos_pair", TAGS + PAIRED + " SELECT langs, tag, lang, upos, count(*) AS n FROM paired GROUP BY ALL")
def pos_pair(spark, d):
    rows = tags(spark, d, "1.5").select("page_id", "langs", "tag")
    found = P.pos_pair(rows, T.pos_map(spark, d)).withColumn("langs", F.array_join("langs", ","))
    return _counted(found, "langs", "tag", "lang", "upos")


@query(
    "pos_pair_homogeneous",
    TAGS + MERGED + " SELECT lang, u.tag, coalesce(upos, CASE WHEN u.tag = 'UKN' THEN 'X' END) AS upos, count(*) AS n FROM ukn u LEFT JOIN merged USING (tag) GROUP BY ALL",
)
def pos_pair_homogeneous(spark, d):
    rows = tags(spark, d).select("langs", F.col("tag_ukn").alias("tag"))
    return _counted(P.pos_pair_homogeneous(rows, P.merge_tag_maps(T.pos_map(spark, d))), "lang", "tag", "upos")


@query(
    "pos_checked_homogeneous",
    TAGS + MERGED + " SELECT u.tag, CASE WHEN u.tag = 'UKN' THEN '' ELSE coalesce(upos, 'X') END AS upos, count(*) AS n FROM ukn u LEFT JOIN merged USING (tag) GROUP BY ALL",
)
def pos_checked_homogeneous(spark, d):
    rows = tags(spark, d).select(F.col("tag_ukn").alias("tag"))
    return _counted(P.pos_checked_homogeneous(rows, P.merge_tag_maps(T.pos_map(spark, d))), "tag", "upos")


@query("missing_pos_stats", TAGS + PAIRED + " SELECT lang || ':' || tag AS lang_tag, count(*) AS n FROM paired WHERE upos = 'X' GROUP BY ALL")
def missing_pos_stats(spark, d):
    return P.missing_pos(tags(spark, d, "1.5").select("page_id", "langs", "tag"), T.pos_map(spark, d))


@query(
    "pos_map_coverage",
    TAGS + " SELECT plang AS lang, count(*) AS n, plang IS NOT NULL AND plang IN (SELECT lang FROM pos_map) AS mapped, 2 AS n_mapped_languages FROM tagged GROUP BY ALL",
)
def pos_map_coverage(spark, d):
    return P.map_coverage(tags(spark, d).select("lang"), T.pos_map(spark, d))


LANGS15 = "WITH " + Q.pages_cte() + """, lab AS (SELECT page_id, unnest(CASE WHEN plang IS NULL THEN []::VARCHAR[] WHEN lang = 'en' THEN ['en'] ELSE [lang, 'en'] END) AS lang FROM pg)"""


@query("page_lang_labels_v15", LANGS15 + " SELECT page_id, lang FROM lab")
def page_lang_labels_v15(spark, d):
    return X.unfold(X.explode_pages(T.volumes(spark, d, "1.5", bodies=False)), "langs", "lang", "page_id")


@query("page_lang_label_v2", "WITH " + Q.pages_cte() + " SELECT page_id, plang AS lang FROM pg WHERE plang IS NOT NULL")
def page_lang_label_v2(spark, d):
    return X.unfold(X.explode_pages(T.volumes(spark, d, bodies=False)), "langs", "lang", "page_id")


@query("page_lang_frequency", LANGS15 + " SELECT lang, count(*) AS n FROM lab GROUP BY lang")
def page_lang_frequency(spark, d):
    return counts.page_lang_frequency(X.explode_pages(T.volumes(spark, d, "1.5", bodies=False)))


@query("page_lang_frequency_v2", "WITH " + Q.pages_cte() + " SELECT plang AS lang, count(*) AS n FROM pg WHERE plang IS NOT NULL GROUP BY 1")
def page_lang_frequency_v2(spark, d):
    return counts.page_lang_frequency(X.explode_pages(T.volumes(spark, d, bodies=False)))


@query("catalog_lang_frequency", "SELECT lang, count(*) AS n FROM documents WHERE lang <> 'es' GROUP BY lang")
def catalog_lang_frequency(spark, d):
    return counts.catalog_lang_frequency(T.parsed_metadata(spark, d, "1.5"))


@query(
    "catalog_lang_frequency_v2",
    "SELECT l AS lang, count(*) AS n FROM (SELECT unnest(CASE doc_id % 3 WHEN 0 THEN [lang] ELSE [lang, 'la'] END) AS l FROM documents WHERE doc_id % 29 <> 0 AND doc_id % 3 < 2) GROUP BY l",
)
def catalog_lang_frequency_v2(spark, d):
    return counts.catalog_lang_frequency(T.parsed_metadata(spark, d))
