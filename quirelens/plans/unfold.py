"""Queries: identifiers, unfolding and audits, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelens.functions import ids
from quirelens.operators import explode as X
from quirelens.operators import sampling
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query

WITH_PAGES = "WITH " + Q.pages_cte()
IDS = f"""WITH ids AS (SELECT url AS id FROM pages UNION ALL SELECT {Q.DOC_ID} FROM documents
  UNION ALL SELECT 'xyz.' || (doc_id + 50281736400917) || '.v' || n_chars FROM documents
  UNION ALL (SELECT DISTINCT source FROM documents))"""
REST = "CASE WHEN contains(id, '.') THEN substr(id, position('.' IN id) + 1) ELSE id END"
STUBBY = f"""{IDS}, parts AS (SELECT id, string_split(id, '.')[1] AS inst, replace(replace(replace({REST}, '/', '='), ':', '+'), '.', ',') AS safe FROM ids),
stub AS (SELECT id, inst || '/' || array_to_string(list_transform(range(1, length(safe) + 1, 3), lambda p: substr(safe, p, 1)), '')
  || '/' || inst || '.' || safe || '.json.bz2' AS path FROM parts)"""


@query("explode_pages", WITH_PAGES + " SELECT volume_id, page_id, page_index, plang AS lang, has_body FROM pg")
def explode_pages(spark, d):
    pages = X.explode_pages(T.volumes(spark, d))
    return pages.select(
        "volume_id", "page_id", "page_index", F.get("langs", F.lit(0)).alias("lang"), F.col("body").isNotNull().alias("has_body")
    )


@query(
    "explode_tokens",
    Q.tokens() + " SELECT page_id, count(*) AS n_tokens, sum(len(tags)) AS n_tags, min(token) AS first_token, max(token) AS last_token FROM tokt GROUP BY page_id",
)
def explode_tokens(spark, d):
    tokens = X.explode_tokens(X.explode_pages(T.volumes(spark, d)))
    return X.token_ranges(tokens.select("page_id", "token", F.size("pos_tags").alias("n_tags")), "page_id")


@query("explode_pos", Q.tokens() + " SELECT page_id, tag, count(*) AS n, min(token) AS first_token, max(token) AS last_token FROM tagged GROUP BY page_id, tag")
def explode_pos(spark, d):
    tags = X.explode_pos(X.explode_tokens(X.explode_pages(T.volumes(spark, d))))
    found = X.token_ranges(tags.select("page_id", "tag", "token", F.lit(1).alias("n_tags")), "page_id", "tag")
    return found.select("page_id", "tag", F.col("n_tokens").alias("n"), "first_token", "last_token")


@query("page_filter", WITH_PAGES + " SELECT page_id FROM ix")
def page_filter(spark, d):
    return X.indexable_pages(X.explode_pages(T.volumes(spark, d))).select("page_id")


@query("page_count_audit", WITH_PAGES + " SELECT volume_id, page_count, n_lines AS n_pages FROM vol WHERE n_lines <> page_count")
def page_count_audit(spark, d):
    return X.audit_page_counts(T.volumes(spark, d))


ZONE_ROWS = """, zone AS (
 SELECT page_id, 'body' AS zone, 'tokenPosCount' AS count_map, token AS key, CASE WHEN length(token) = 1 THEN 0 ELSE 2 + CASE WHEN len(tags) = 2 THEN 3 ELSE 0 END END AS n FROM tokt
 UNION ALL SELECT DISTINCT page_id, 'body', 'beginCharCounts', substr(k, 1, 1), 1 FROM (SELECT page_id, unnest(ks) AS k FROM pg WHERE has_body)
 UNION ALL SELECT DISTINCT page_id, 'body', 'endCharCount', right(k, 1), 1 FROM (SELECT page_id, unnest(ks) AS k FROM pg WHERE has_body)
 UNION ALL SELECT page_id, 'header', 'tokenPosCount', 'p.' || page_index, 1 FROM pg
 UNION ALL SELECT page_id, 'header', 'beginCharCounts', 'p', 1 FROM pg
 UNION ALL SELECT page_id, 'header', 'endCharCount', right(page_index::VARCHAR, 1), 1 FROM pg)"""


@query("explode_zones", Q.tokens() + ZONE_ROWS + " SELECT zone, count_map, key, count(*) AS n_pages, sum(n) AS total FROM zone GROUP BY ALL")
def explode_zones(spark, d):
    rows = X.explode_zones(X.explode_pages(T.volumes(spark, d, zones=True)))
    return rows.groupBy("zone", "count_map", "key").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("total"))


@query("missing_metadata", f"SELECT {Q.DOC_ID} AS volume_id FROM documents WHERE doc_id % 29 = 0")
def missing_metadata(spark, d):
    return X.missing_metadata(T.parsed_metadata(spark, d))


@query(
    "strip_id_prefix",
    f"SELECT volume_id, volume_id AS stripped, volume_id AS unprefixed FROM (SELECT {Q.DOC_ID} AS volume_id FROM documents)",
)
def strip_id_prefix(spark, d):
    rows = T.volumes(spark, d).select("id", "volume_id")
    return rows.select("volume_id", ids.volume_id(F.col("id")).alias("stripped"), ids.volume_id(F.col("volume_id")).alias("unprefixed"))


@query("page_id", f"SELECT doc_id, printf('%s.page-%06d', {Q.DOC_ID}, n_chars) AS page_id FROM documents")
def page_id(spark, d):
    rows = T._documents(spark, d, "documents")
    return rows.select("doc_id", ids.page_id(F.col("volume_id"), F.col("n_chars")).alias("page_id"))


FRIENDLY = "replace(replace(id, '/', '='), ':', '+')"


@query(
    "id_os_friendly",
    f"""{IDS}, m AS (SELECT id, {FRIENDLY} AS s FROM ids)
 SELECT id, CASE WHEN contains(s, '.') THEN string_split(s, '.')[1] || '.' || array_to_string(string_split(s, '.')[2:], ',') ELSE s END AS friendly FROM m""",
)
def id_os_friendly(spark, d):
    return T.id_list(spark, d).select("id", ids.os_friendly(F.col("id")).alias("friendly"))


@query(
    "pairtree_to_id",
    STUBBY + " SELECT path, replace(replace(replace(regexp_replace(string_split(path, '/')[-1], '\\.json\\.bz2$', ''), '=', '/'), '+', ':'), ',', '.') AS id FROM stub",
)
def pairtree_to_id(spark, d):
    return T.stubby_paths(spark, d).select("path", ids.pairtree_to_id(F.col("path")).alias("id"))


@query("id_to_stubby", STUBBY + " SELECT id, path FROM stub")
def id_to_stubby(spark, d):
    return T.id_list(spark, d).select("id", ids.id_to_stubby(F.col("id")).alias("path"))


@query("concept_volume_id", "WITH " + Q.CONCEPTS + " SELECT collection, document, volume_id, count(*) AS n FROM con GROUP BY ALL")
def concept_volume_id(spark, d):
    rows = T.concepts(spark, d).select(F.col("collectionName").alias("collection"), F.col("documentId").alias("document"))
    named = rows.withColumn("volume_id", ids.concept_volume_id(F.col("collection"), F.col("document")))
    return named.groupBy("collection", "document", "volume_id").agg(F.count(F.lit(1)).alias("n"))


@query("concept_page_id", "WITH " + Q.CONCEPTS + " SELECT source_page, page_id FROM con")
def concept_page_id(spark, d):
    return T.concepts(spark, d).select(F.col("pageId").alias("source_page"), ids.concept_page_id(F.col("pageId")).alias("page_id"))


@query("docstore_key", "SELECT url, replace(replace(url || '$' || page_id, '.', '<PERIOD>'), '$', '<DOLLAR>') AS safe FROM pages")
def docstore_key(spark, d):
    rows = T.read(spark, d, "pages")
    return rows.select("url", ids.safe_key(F.concat("url", F.lit("$"), F.col("page_id").cast("string"))).alias("safe"))


DIGEST = "CAST('0x' || substr(md5('42:' || {0}), 1, 8) AS BIGINT) < {1}"


@query(
    "sample_10000",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE " + DIGEST.format("l_orderkey || ':' || l_linenumber", int(0.0001 * 2**32)),
)
def sample_10000(spark, d):
    key = F.concat_ws(":", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return sampling.sample_keyed(T.read(spark, d, "lineitem"), key, 0.0001).select("l_orderkey", "l_linenumber")


@query("sample_100", "SELECT doc_id, source FROM documents WHERE " + DIGEST.format("doc_id", int(0.01 * 2**32)))
def sample_100(spark, d):
    rows = sampling.sample_keyed(T.read(spark, d, "documents"), F.col("doc_id").cast("string"), 0.01, partitions=120)
    return rows.select("doc_id", "source")


@query(
    "sample_every_n",
    IDS + " SELECT id, position FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM ids) WHERE position % 100 = 0",
)
def sample_every_n(spark, d):
    return sampling.every_n(T.id_list(spark, d), ["id"], 100)


@query(
    "size_partitions",
    "SELECT source, count(*) AS n, count(*) // 3000 + 1 AS n_default, greatest(count(*) // 3000 + 1, 100) AS n_floored, count(*) // 7 + 1 AS n_small FROM documents GROUP BY source",
)
def size_partitions(spark, d):
    counts = T.read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return counts.select(
        "source", "n",
        sampling.partition_count(n).alias("n_default"),
        sampling.partition_count(n, minimum=100).alias("n_floored"),
        sampling.partition_count(n, per=7).alias("n_small"),
    )
