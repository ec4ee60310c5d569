"""Queries: concept updates and the document store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.operators import concepts as C
from quirelens.operators import counts, docstore
from quirelens.operators import explode as X
from quirelens.operators.store import KeyedStore
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query
from quirelens.plans.unfold import ZONE_ROWS
from quirelens.settings import ZONES, shared_path

CON = "WITH " + Q.CONCEPTS


@query("concept_texts", CON + " SELECT source_page, len(vals) AS n_texts, array_to_string(vals, '|') AS texts FROM con")
def concept_texts(spark, d):
    found = T.concepts(spark, d).select(F.col("pageId").alias("source_page"), C.concept_texts(F.col("concepts")).alias("v"))
    return found.select("source_page", F.size("v").alias("n_texts"), F.array_join("v", "|").alias("texts"))


@query(
    "partial_update_fields",
    CON + """, shape(lvl, field) AS (VALUES ('page', 'volumeconcept_txt'), ('page', 'volumeconcept_htrcstrings'), ('volume', 'concept_t'), ('volume', 'concept_ss'))
 SELECT source_page, mode, field, array_to_string(vals, '|') AS joined FROM con, shape, (VALUES ('add'), ('remove')) m(mode)""",
)
def partial_update_fields(spark, d):
    rows = C.identified(T.concepts(spark, d)).select("source_page", "values")
    made = [C.partial_update(rows, level, mode) for level in ("page", "volume") for mode in ("remove", "add")]
    return (
        made[0].unionAll(made[1]).unionAll(made[2]).unionAll(made[3])
        .select("source_page", "mode", "field", F.array_join("values", "|").alias("joined"))
    )


def _flat(updates: DataFrame, *keys: str) -> DataFrame:
    return C.update_json(updates).select(*keys, "ord", "target_id", "mode", "json")


COMMAND = """'{"id":"' || target_id || '","' || f1 || '":{"' || mode || '":' || js || '},"' || f2 || '":{"' || mode || '":' || js || '}}'"""
JS = """'[' || array_to_string(list_transform(vals, lambda v: '"' || v || '"'), ',') || ']' AS js"""


@query(
    "concept_page_updates",
    CON + f""", cmd AS (SELECT volume_id, page_id, s.ord, s.mode, {JS},
  CASE WHEN s.ord < 2 THEN volume_id || '.' || page_id ELSE volume_id END AS target_id,
  CASE WHEN s.ord < 2 THEN 'volumeconcept_txt' ELSE 'concept_t' END AS f1,
  CASE WHEN s.ord < 2 THEN 'volumeconcept_htrcstrings' ELSE 'concept_ss' END AS f2
  FROM con, (VALUES (0, 'remove'), (1, 'add'), (2, 'remove'), (3, 'add')) s(ord, mode) WHERE page_id IS NOT NULL AND len(vals) > 0)
 SELECT volume_id, page_id, ord, target_id, mode, {COMMAND} AS json FROM cmd""",
)
def concept_page_updates(spark, d):
    return _flat(C.page_updates(T.concepts(spark, d)), "volume_id", "page_id")


@query(
    "concept_volume_updates",
    f"""WITH v AS (SELECT {Q.DOC_ID} AS volume_id, flatten(list_transform(string_split(text, chr(10)), lambda s: list_filter(regexp_extract_all(s, '{Q.TOK}'), lambda w: length(w) > 12))) AS vals
  FROM documents WHERE contains(text, chr(10))),
 cmd AS (SELECT volume_id, s.ord, s.mode, {JS}, volume_id AS target_id, 'concept_t' AS f1, 'concept_ss' AS f2 FROM v, (VALUES (0, 'remove'), (1, 'add')) s(ord, mode))
 SELECT volume_id, ord, target_id, mode, {COMMAND} AS json FROM cmd""",
)
def concept_volume_updates(spark, d):
    return _flat(C.volume_updates(T.concept_volumes(spark, d)), "volume_id")


# Stored values come from the user's turns, updates from the assistant's.
APPLIED = (
    CON + """, val AS (SELECT volume_id, page_id, turn, role, unnest(vals) AS value FROM con WHERE page_id IS NOT NULL),
 named AS (SELECT volume_id || '.' || page_id AS id, unnest(['volumeconcept_txt', 'volumeconcept_htrcstrings']) AS field, value, turn, role FROM val
  UNION ALL SELECT volume_id, unnest(['concept_t', 'concept_ss']), value, turn, role FROM val),
 num AS (SELECT id, field, value, turn, role, count(*) AS n FROM named GROUP BY ALL),
 store AS (SELECT id, field, value, sum(n) AS n FROM num WHERE role = 'user' GROUP BY ALL),
 upd AS (SELECT id, field, value, arg_max(n, turn) AS n FROM num WHERE role <> 'user' GROUP BY ALL)
 SELECT id, field, value, coalesce(u.n, s.n) AS n FROM store s FULL JOIN upd u USING (id, field, value)"""
)


def _stored_and_updates(spark, d):
    records = T.concepts(spark, d)
    asked = F.exists("concepts", lambda c: c["text"].isNull())

    def numbered(rows):
        return C.value_counts(C.page_updates(rows), ["page_id"])

    store = numbered(records.filter(asked)).groupBy("id", "field", "value").agg(F.sum("n").alias("n"))
    return store, numbered(records.filter(~asked))


@query("apply_updates", APPLIED)
def apply_updates(spark, d):
    return C.apply_updates(*_stored_and_updates(spark, d), "page_id")


@query("apply_updates_rounds", APPLIED)
def apply_updates_rounds(spark, d):
    """The same values from a store that takes the updates in three rounds, by page."""
    stored, incoming = _stored_and_updates(spark, d)
    store = KeyedStore.create(stored, shared_path(spark, "values"), ["id", "field", "value"])
    page = F.col("page_id")
    for of in (page <= "page-000002", (page > "page-000002") & (page <= "page-000004"), page > "page-000004"):
        store.update(C.last_updates(incoming.filter(of), "page_id"))
    return store.rows()


@query("no_concepts_report", CON + " SELECT volume_id, source_page FROM con WHERE len(vals) = 0")
def no_concepts_report(spark, d):
    return C.pages_without_concepts(T.concepts(spark, d))


@query("concept_bad_pages", CON + " SELECT volume_id, source_page FROM con WHERE page_id IS NULL")
def concept_bad_pages(spark, d):
    return C.bad_page_names(T.concepts(spark, d))


@query("concept_record_count", "SELECT count(*) AS n_records FROM conversations")
def concept_record_count(spark, d):
    return counts.concept_record_count(T.concepts(spark, d))


SAFE = "replace(replace({0}, '.', '<PERIOD>'), '$', '<DOLLAR>')"


@query(
    "docstore_keys",
    Q.tokens() + ZONE_ROWS + f""", safe AS (SELECT zone, count_map, {SAFE.format('key')} AS key FROM zone
  UNION ALL SELECT 'body', 'tags', tag FROM tagged UNION ALL SELECT 'header', 'tags', 'C<DOLLAR>D' FROM pg)
 SELECT zone, count_map, key, count(*) AS n_pages FROM safe GROUP BY ALL""",
)
def docstore_keys(spark, d):
    pages = docstore.safe_zone_maps(X.explode_pages(T.volumes(spark, d, zones=True)))

    def names(zone: str) -> dict[str, Column]:
        tokens = F.col(f"{zone}.tokenPosCount")
        return {
            "tokenPosCount": F.map_keys(tokens),
            "beginCharCounts": F.map_keys(f"{zone}.beginCharCounts"),
            "endCharCount": F.map_keys(f"{zone}.endCharCount"),
            "tags": F.flatten(F.transform(F.map_values(tokens), F.map_keys)),
        }

    # the names alone are unfolded and counted under a map's number: no map is copied, and what it is called is added to the counts
    maps = [(F.struct(F.lit(z).alias("zone"), F.lit(n).alias("count_map")), k) for z in ZONES for n, k in names(z).items()]
    per_map = pages.select(F.posexplode_outer(F.array(*[k for _, k in maps])).alias("m", "names"))
    counted = X.unfold(per_map, "names", "key", "m").groupBy("m", "key").agg(F.count(F.lit(1)).alias("n_pages"))
    return counted.withColumn("of", F.get(F.array(*[called for called, _ in maps]), F.col("m"))).select("of.zone", "of.count_map", "key", "n_pages")


@query("docstore_id", f"WITH v AS (SELECT {Q.DOC_ID} AS vid, text FROM documents) SELECT 'https://data.example.org/extracted-features/20240115/' || vid AS _id FROM v")
def docstore_id(spark, d):
    return docstore.docstore_rows(T.volumes(spark, d)).select("_id")


REPLACED = """WITH store AS (SELECT CAST(doc_id AS VARCHAR) AS _id, lang || ':' || n_chars AS doc FROM documents),
 new AS (SELECT CAST(doc_id AS VARCHAR) AS _id, 'q' || quality || 't' || toxic AS doc FROM labels UNION ALL SELECT 'c' || conv_id, role FROM conversations),
 last AS (SELECT _id, max(doc) AS doc FROM new GROUP BY _id)
 SELECT _id, coalesce(last.doc, store.doc) AS doc FROM store LEFT JOIN last USING (_id)"""


def _stored_and_incoming(spark, d):
    store = T.read(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("_id"), F.concat_ws(":", "lang", F.col("n_chars").cast("string")).alias("doc")
    )
    labels = T.read(spark, d, "labels").select(
        F.col("doc_id").cast("string").alias("_id"), F.format_string("q%dt%d", F.col("quality"), F.col("toxic")).alias("doc")
    )
    unknown = T.read(spark, d, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("_id"), F.col("role").alias("doc")
    )
    return store, labels, unknown


@query("docstore_replace", REPLACED)
def docstore_replace(spark, d):
    store, labels, unknown = _stored_and_incoming(spark, d)
    return docstore.replace_only(store, labels.unionAll(unknown))


@query("docstore_replace_rounds", REPLACED)
def docstore_replace_rounds(spark, d):
    """The same documents from a store that takes the two sources one after the other."""
    stored, labels, unknown = _stored_and_incoming(spark, d)
    store = KeyedStore.create(stored, shared_path(spark, "docstore"), ["_id"])
    for incoming in (labels, unknown):
        store.update(docstore.last_incoming(incoming), add=False)
    return store.rows()
