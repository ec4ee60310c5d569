"""Queries: sources, sinks and totals. Files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelens.functions import ids
from quirelens.operators import counts
from quirelens.operators import explode as X
from quirelens.operators import fields as M
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query
from quirelens.plans.text import page_tokens
from quirelens.plans.unfold import IDS, STUBBY
from quirelens.settings import shared_path
from quirelens.sinks import files, named, updates
from quirelens.sources import listed, lists, records

VOLS = "WITH " + Q.pages_cte()


def _damaged(spark, d, version="2"):
    """Record text with some records cut short or without features, by what their text ends in; ``source`` comes along."""
    raw = T.raw_volumes(spark, d, version, keep=(F.right("text", F.lit(1)), F.col("source"))).withColumnsRenamed({"_keep0": "last", "_keep1": "source"})
    cut = F.substr(F.col("json"), F.lit(1), F.length("json") - 40)
    json = (
        F.when(F.col("last") == "|", cut)
        .when(F.col("last") == "#", F.concat(F.lit('{"id":"'), F.col("key"), F.lit('"}')))
        .when(F.col("last") == "&", F.lit('{"features":{"pageCount":1,"pages":[]}}'))
        .otherwise(F.col("json"))
    )
    return raw.select("key", json.alias("json"), "source")


@query("src_sequencefile", VOLS + " SELECT volume_id, page_count, n_lines AS n_pages, CASE WHEN doc_id % 29 = 0 THEN NULL ELSE source || ' vol. ' || doc_id || '; a \"new\" edition' END AS title FROM vol")
def src_sequencefile(spark, d):
    path = shared_path(spark, "packed")
    files.write_packed(T.raw_volumes(spark, d), path)
    good, _ = records.parse_volumes(records.read_packed(spark, path))
    title = F.try_variant_get(F.try_parse_json("metadata"), "$.title", "string")
    return good.select("volume_id", "page_count", F.size("pages").alias("n_pages"), title.alias("title"))


def _write_files(spark, d):
    """One compressed JSON file per volume under its own path; returns the folder, its lists and (path) of all."""
    root = shared_path(spark, "files")
    raw = T.raw_volumes(spark, d).withColumn("path", ids.id_to_stubby(F.col("key")))
    return root, named.write_named(raw, root), raw.select("path")


@query("src_filelist", VOLS + " SELECT volume_id, page_count, n_lines AS n_pages FROM vol")
def src_filelist(spark, d):
    root, _, paths = _write_files(spark, d)
    list_path = shared_path(spark, "filelist")
    paths.write.text(list_path)
    raw = listed.read_listed(spark, list_path, root).withColumnRenamed("path", "key")
    good, _ = records.parse_volumes(raw)
    return good.select("volume_id", "page_count", F.size("pages").alias("n_pages"))


@query("word_frequency_filelist", Q.terms() + " SELECT lower(term) AS term, count(*) AS n FROM trm GROUP BY lower(term)")
def word_frequency_filelist(spark, d):
    root, lists_, _ = _write_files(spark, d)
    raw = listed.read_listed(spark, lists_, root).withColumnRenamed("path", "key")
    good, _ = records.parse_volumes(raw)
    return counts.word_frequency(X.explode_tokens(X.explode_pages(good)))


@query(
    "src_volume_json",
    VOLS + """ SELECT volume_id AS key, CASE right(text, 1) WHEN '|' THEN 'unparsable' WHEN '#' THEN 'no features' WHEN '&' THEN 'no id' END AS reason,
 CASE WHEN right(text, 1) IN ('|', '#', '&') THEN NULL ELSE n_lines END AS n_pages FROM vol""",
)
def src_volume_json(spark, d):
    judged = records.judge_volumes(_damaged(spark, d).drop("source"))
    return judged.select("key", "reason", F.when(F.col("reason").isNull(), F.size("pages")).alias("n_pages"))


CONCEPT_ROWS = "WITH " + Q.CONCEPTS + " SELECT document, collection, source_page, array_to_string(vals, '|') AS texts FROM con"


def _concept_rows(found):
    return found.select(
        F.col("documentId").alias("document"), F.col("collectionName").alias("collection"), F.col("pageId").alias("source_page"),
        F.array_join("concepts.text", "|").alias("texts"),
    )


@query("src_concept_lines", CONCEPT_ROWS)
def src_concept_lines(spark, d):
    path = shared_path(spark, "concepts")
    lists.to_oneliners(T.concepts(spark, d)).write.text(path)
    return _concept_rows(lists.read_concepts(spark, path))


def _array_lines(batches):
    import pandas as pd

    yield pd.DataFrame({"value": ["["]})
    mark = ""
    for batch in batches:
        lines = batch["line"].copy()
        if len(lines):
            lines.iloc[0] = mark + lines.iloc[0]
            lines.iloc[1:] = "," + lines.iloc[1:]
            mark = ","
        yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]"]})


@query("src_concept_array", CONCEPT_ROWS)
def src_concept_array(spark, d):
    arrays, lines = shared_path(spark, "concept-arrays"), shared_path(spark, "concept-lines")
    lists.to_oneliners(T.concepts(spark, d)).mapInPandas(_array_lines, "value string").write.text(arrays)
    lists.to_oneliners(lists.read_concept_array(spark, arrays)).write.text(lines)
    return _concept_rows(lists.read_concepts(spark, lines))


# Every document serves as one map file: a line with one comma makes two parts.
@query(
    "src_pos_maps",
    """WITH f AS (SELECT text, md5(CAST(doc_id AS VARCHAR)) || '.map' AS file FROM documents),
 kept AS (SELECT substr(file, 1, 2) AS lang, arg_max(string_split(replace(text, ', ', chr(9)), chr(10)), file) AS lines FROM f GROUP BY 1),
 ln AS (SELECT lang, unnest(range(1, len(lines) + 1)) AS i, lines FROM kept),
 parts AS (SELECT lang, i, string_split(rtrim(lines[i], chr(9)), chr(9)) AS p FROM ln
  WHERE NOT starts_with(lines[i], '#') AND NOT regexp_matches(lines[i], '^\\s*$'))
 SELECT lang, p[1] AS tag, arg_max(p[2], i) AS upos FROM parts WHERE len(p) = 2 GROUP BY lang, p[1]""",
)
def src_pos_maps(spark, d):
    root = shared_path(spark, "maps")
    rows = T.read(spark, d, "documents").select(
        F.concat(F.lit("maps/"), F.md5(F.col("doc_id").cast("string")), F.lit(".map")).alias("path"),
        F.replace("text", F.lit(", "), F.lit("\t")).alias("json"),
    )
    named.write_named(rows, root)
    return lists.read_pos_maps(spark, f"{root}/maps")


@query("src_dictionary", "WITH " + Q.DICT[1:] + " SELECT word FROM dict")
def src_dictionary(spark, d):
    path = shared_path(spark, "dictionary")
    T.dictionary(spark, d).write.text(path)
    return lists.read_dictionary(spark, path)


@query("dictionary_size", "WITH " + Q.DICT[1:] + " SELECT count(*) AS n_words FROM dict")
def dictionary_size(spark, d):
    path = shared_path(spark, "dictionary")
    T.dictionary(spark, d).write.text(path)
    return counts.dictionary_size(spark.read.text(path))


def _written_ids(spark, d):
    path = shared_path(spark, "ids")
    T.id_list(spark, d).write.text(path)
    return lists.read_ids(spark, path)


@query("src_id_list", IDS + " SELECT id FROM ids")
def src_id_list(spark, d):
    return _written_ids(spark, d)


@query("id_list_to_stubby", STUBBY + " SELECT path FROM stub")
def id_list_to_stubby(spark, d):
    return _written_ids(spark, d).select(ids.id_to_stubby(F.col("id")).alias("path"))


@query("sink_sequencefile", VOLS + " SELECT volume_id AS key, volume_id, page_count FROM vol")
def sink_sequencefile(spark, d):
    path = shared_path(spark, "packed")
    files.write_packed(T.raw_volumes(spark, d), path)
    return records.judge_volumes(records.read_packed(spark, path), pages=False).select("key", "volume_id", "page_count")


@query("sink_counts_text", Q.tokens() + " SELECT '(' || tag || ',' || count(*) || ')' AS value FROM tagged GROUP BY tag")
def sink_counts_text(spark, d):
    path = shared_path(spark, "counts")
    files.write_counts(counts.pos_frequency(page_tokens(spark, d)), "tag", path)
    return spark.read.text(path)


@query(
    "endpoint_expand",
    """WITH t AS (SELECT page_id, CASE WHEN contains(url, '?') AND contains(url, 'm.') THEN NULL
   ELSE regexp_extract(url, '^https?://[^/]+') || CASE WHEN contains(url, '#') THEN '/search' ELSE ':8983/search' END END AS base,
  'c' || page_id AS collection, CASE WHEN contains(url, '/en/') THEN NULL WHEN contains(url, '/fr/') THEN 'n' || page_id || ':80' ELSE 'node1:8983,node2:9000' END AS nodes FROM pages),
 e AS (SELECT page_id, base || '/' || collection || '/update' AS plain, unnest(CASE WHEN nodes IS NULL THEN [NULL] ELSE string_split(nodes, ',') END) AS node FROM t WHERE base IS NOT NULL)
 SELECT page_id, node, CASE WHEN node IS NULL THEN plain ELSE regexp_replace(plain, '//.*?:\\d+/', '//' || node || '/') END AS url FROM e""",
)
def endpoint_expand(spark, d):
    url = F.col("url")
    host = F.regexp_extract(url, "^https?://[^/]+", 0)
    rows = T.read(spark, d, "pages").select(
        "page_id",
        F.when(~(F.contains(url, F.lit("?")) & F.contains(url, F.lit("m."))), F.concat(host, F.when(F.contains(url, F.lit("#")), "/search").otherwise(":8983/search"))).alias("base"),
        F.concat(F.lit("c"), F.col("page_id").cast("string")).alias("collection"),
        F.when(F.contains(url, F.lit("/en/")), F.lit(None))
        .when(F.contains(url, F.lit("/fr/")), F.concat(F.lit("n"), F.col("page_id").cast("string"), F.lit(":80")))
        .otherwise("node1:8983,node2:9000").alias("nodes"),
    )
    return updates.expand_endpoints(rows).select("page_id", "node", "url")


@query(
    "output_naming",
    """SELECT page_id, 'whitelist-' || string_split(string_split(url, '/')[-1], '.')[1] || '-out' AS from_url,
 'pos-' || 'list' || page_id || '-out' AS from_list FROM pages""",
)
def output_naming(spark, d):
    rows = T.read(spark, d, "pages")
    listed = F.concat(F.lit("/data/"), "url", F.lit("/list"), F.col("page_id").cast("string"), F.lit(".v2.txt"))
    return rows.select("page_id", ids.output_name(F.col("url"), "whitelist").alias("from_url"), ids.output_name(listed, "pos").alias("from_list"))


@query(
    "catalog_lang_frequency_packed",
    "SELECT CASE WHEN lang = 'es' OR right(text, 1) IN ('|', '#', '&') THEN NULL ELSE lang END AS lang, count(*) AS n FROM documents GROUP BY 1",
)
def catalog_lang_frequency_packed(spark, d):
    """A record that cannot be used has no language, and counts."""
    path = shared_path(spark, "packed")
    files.write_packed(_damaged(spark, d, "1.5"), path)
    judged = records.judge_volumes(records.read_packed(spark, path), "1.5", pages=False)
    metadata = F.when(F.col("reason").isNull(), F.col("metadata")).alias("metadata")
    return counts.catalog_lang_frequency(M.parse_metadata(judged.select("volume_id", metadata)), keep_null=True)


@query("volume_count", "SELECT count(*) AS n_volumes FROM documents")
def volume_count(spark, d):
    return counts.volume_count(T.volumes(spark, d))


@query("pages_per_volume", VOLS + " SELECT volume_id, n_lines AS n_pages FROM vol")
def pages_per_volume(spark, d):
    return counts.pages_per_volume(T.volumes(spark, d))


@query("volume_total_reduce", "SELECT count(*) AS n_volumes FROM documents")
def volume_total_reduce(spark, d):
    return counts.volume_total(T.volumes(spark, d))


@query("page_total", VOLS + " SELECT sum(page_count) AS n_pages FROM vol")
def page_total(spark, d):
    return counts.page_total(T.volumes(spark, d))


@query(
    "progress_metrics",
    """WITH seen AS (SELECT source, right(text, 1) IN ('|', '#', '&') AS bad FROM documents)
 SELECT source, count(*) FILTER (NOT bad) AS n_done, count(*) AS n_total, 100.0 * count(*) FILTER (NOT bad) / count(*) AS percent FROM seen GROUP BY source""",
)
def progress_metrics(spark, d):
    raw = _damaged(spark, d)
    sources = raw.select("key", "source")
    done = records.judge_volumes(raw.drop("source")).filter(F.col("reason").isNull()).select("key")
    return counts.progress(done, sources, "key", "source")
