"""Queries: metadata fields, text fields and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelens.operators import documents as D
from quirelens.operators import explode as X
from quirelens.operators import fields as M
from quirelens.operators.terms import term_arrays
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query
from quirelens.plans.text import KEPT_TERMS, token_pages


def _field_query(key: str, part, version: str):
    @query(key, Q.field_check(key))
    def made(spark, d):
        known = T.parsed_metadata(spark, d, version).filter(F.col("metadata").isNotNull())
        typed, entries = M.typed_metadata(known, version, [part])
        both = F.concat(M.field_rows(entries, M.VOLUME), M.field_rows(entries, M.PAGE))
        rows = M.doc_fields(typed, "volume_id", both)
        return rows.select("doc_id", "field", "kind", F.size("values").alias("n_values"), F.array_join("values", "|").alias("joined"))

    return made


_field_query("meta2_strings", M.v2_strings, "2")
_field_query("meta2_ints", M.v2_ints, "2")
_field_query("meta2_uris", M.v2_uris, "2")
_field_query("meta2_multi", M.v2_multi, "2")
_field_query("meta2_multi_uri", M.v2_multi_uris, "2")
_field_query("meta2_id_name_type", M.v2_entities, "2")
_field_query("meta2_bibformat", M.v2_bib_format, "2")
_field_query("meta2_source_inst", M.v2_source_institution, "2")
_field_query("meta2_catalog_record", M.v2_catalog_record, "2")
_field_query("meta15_single", M.v15_strings, "1.5")
_field_query("meta15_multi", M.v15_multi, "1.5")
_field_query("meta15_classification", M.v15_classification, "1.5")

ADD_DDL = "add struct<commitWithin: int, doc: map<string, string>>"


def parsed_documents(documents: DataFrame) -> DataFrame:
    """The members of each add command, read back from its text."""
    return documents.select("doc_id", F.from_json("json", ADD_DDL).alias("j")).select(
        "doc_id", F.col("j.add.commitWithin").alias("commit_within"), F.col("j.add.doc").alias("doc")
    )


DOC_ROWS = """, doc AS (SELECT doc_id, field, CASE kind WHEN 'multi' THEN '[' || array_to_string(list_transform(vals, lambda v: '"' || v || '"'), ',') || ']' ELSE vals[1] END AS value
  FROM fld WHERE lvl = 'volume' UNION ALL SELECT vid, 'id', vid FROM meta)
 SELECT doc_id, 120000 AS commit_within, field, value FROM doc"""


@query("volume_document", "WITH " + Q.entries(Q.META2, list(Q.ENTRIES2.values())) + DOC_ROWS)
def volume_document(spark, d):
    made = parsed_documents(D.volume_documents(T.parsed_metadata(spark, d)))
    return X.unfold_map(made, "doc", "field", "value", "doc_id", "commit_within")


@query("volume_document_v15", "WITH " + Q.entries(Q.META15, list(Q.ENTRIES15.values())) + DOC_ROWS)
def volume_document_v15(spark, d):
    made = parsed_documents(D.volume_documents(T.parsed_metadata(spark, d, "1.5"), "1.5"))
    return X.unfold_map(made, "doc", "field", "value", "doc_id", "commit_within")


# Text-field rows of {src}(page_id, plang, tags, term): one language per page.
TEXT_FIELDS = Q.POS_MAP + """, emitted AS (SELECT page_id, plang, term, unnest(tags) AS tag FROM {src} WHERE plang IS NOT NULL),
mapped AS (SELECT page_id, plang, term, coalesce(upos, CASE WHEN plang IN (SELECT lang FROM pos_map) THEN 'X' END) AS upos
  FROM emitted e LEFT JOIN pos_map m ON m.lang = plang AND m.tag = e.tag),
txt AS (SELECT page_id, plang || '_' || upos || '_htrctokentext' AS field, term FROM mapped WHERE upos IS NOT NULL
  UNION ALL SELECT page_id, plang || '_htrctokentext', term FROM mapped
  UNION ALL SELECT page_id, 'alllangs_htrctokentext', term FROM mapped),
flds AS (SELECT page_id, field, count(*) AS n_terms, string_agg(term, ' ' ORDER BY term) AS terms FROM txt GROUP BY page_id, field)"""
LOWERED = ", low AS (SELECT page_id, plang, tags, lower(term) AS term FROM trm)"


def _text_rows(pages: DataFrame, pos_map: DataFrame) -> DataFrame:
    return (
        D.text_fields(pages, pos_map)
        .select("page_id", F.explode_outer("text_fields").alias("f"))
        .filter(F.col("f").isNotNull())
        .select(
            "page_id", "f.field", F.size("f.values").cast("bigint").alias("n_terms"),
            F.array_join(F.sort_array("f.values"), " ").alias("terms"),
        )
    )


@query("lang_pos_text_fields", Q.terms() + LOWERED + TEXT_FIELDS.format(src="low") + " SELECT * FROM flds")
def lang_pos_text_fields(spark, d):
    return _text_rows(term_arrays(token_pages(spark, d)), T.pos_map(spark, d))


@query("lang_pos_text_fields_dictionary", Q.terms() + KEPT_TERMS + TEXT_FIELDS.format(src="kept") + " SELECT * FROM flds")
def lang_pos_text_fields_dictionary(spark, d):
    return _text_rows(term_arrays(token_pages(spark, d), T.dictionary(spark, d)), T.pos_map(spark, d))


TEXT15 = """, p15 AS (SELECT t.page_id, t.term, t.tags, ix.lang, ix.plang FROM low t JOIN ix USING (page_id) WHERE ix.plang IS NOT NULL),
e15 AS (SELECT page_id, lang, term, unnest(tags) AS tag FROM p15),
m15 AS (SELECT page_id, term, CASE WHEN a.upos IS NULL AND b.upos IS NOT NULL THEN 'en' ELSE e.lang END AS plang,
  coalesce(a.upos, b.upos, CASE WHEN e.lang IN (SELECT lang FROM pos_map) THEN 'X' END) AS upos
  FROM e15 e LEFT JOIN pos_map a ON a.lang = e.lang AND a.tag = e.tag LEFT JOIN pos_map b ON b.lang = 'en' AND b.tag = e.tag),
t15 AS (SELECT page_id, plang || '_' || upos || '_htrctokentext' AS field, term FROM m15 WHERE upos IS NOT NULL
  UNION ALL SELECT page_id, plang || '_htrctokentext', term FROM m15 UNION ALL SELECT page_id, 'alllangs_htrctokentext', term FROM m15)
 SELECT page_id, field, count(*) AS n_terms, string_agg(term, ' ' ORDER BY term) AS terms FROM t15 GROUP BY page_id, field"""


@query("lang_pos_text_fields_v15", Q.terms() + LOWERED + Q.POS_MAP + TEXT15)
def lang_pos_text_fields_v15(spark, d):
    pages = X.token_arrays(X.explode_pages(T.volumes(spark, d, "1.5")))
    return _text_rows(term_arrays(pages), T.pos_map(spark, d))


@query("no_text_flag", Q.terms() + KEPT_TERMS + " SELECT page_id, 'efnotext_b' AS field FROM ix WHERE page_id NOT IN (SELECT page_id FROM kept)")
def no_text_flag(spark, d):
    pages = term_arrays(token_pages(spark, d), T.dictionary(spark, d))
    return X.unfold(pages, D.no_text_flag(F.col("terms")), "f", "page_id").select("page_id", "f.field")


PAGE_DOCS = (
    Q.terms() + LOWERED + TEXT_FIELDS.format(src="low") + ", " + Q.entries(Q.META2, list(Q.ENTRIES2.values()))
    + """, names AS (SELECT page_id, field FROM flds
  UNION ALL SELECT page_id, unnest(['id', 'volumeid_s']) FROM ix
  UNION ALL SELECT page_id, 'efnotext_b' FROM ix WHERE page_id NOT IN (SELECT page_id FROM low)
  UNION ALL SELECT page_id, field FROM ix JOIN fld ON fld.doc_id = volume_id AND lvl = 'page'),
 listed AS (SELECT page_id, string_agg(field, ',' ORDER BY field) AS fields FROM names GROUP BY page_id)
 SELECT ix.page_id AS doc_id, volume_id AS volume, fields, terms AS all_terms, t.vals[1] AS title, flag.field IS NOT NULL AS no_text
 FROM ix JOIN listed USING (page_id) LEFT JOIN (SELECT * FROM flds WHERE field = 'alllangs_htrctokentext') a USING (page_id)
 LEFT JOIN (SELECT * FROM fld WHERE field = 'volumetitle_txt') t ON t.doc_id = volume_id
 LEFT JOIN (SELECT * FROM names WHERE field = 'efnotext_b') flag USING (page_id)"""
)


@query("page_document", PAGE_DOCS)
def page_document(spark, d):
    found = M.parse_metadata(T.volumes(spark, d, metadata=True))
    made = parsed_documents(D.page_documents(found, T.pos_map(spark, d)))
    terms = F.from_json(F.col("doc")["alllangs_htrctokentext"], "array<string>")
    return made.select(
        "doc_id",
        F.col("doc")["volumeid_s"].alias("volume"),
        F.array_join(F.sort_array(F.map_keys("doc")), ",").alias("fields"),
        F.array_join(F.sort_array(terms), " ").alias("all_terms"),
        F.col("doc")["volumetitle_txt"].alias("title"),
        F.coalesce(F.col("doc")["efnotext_b"] == "true", F.lit(False)).alias("no_text"),
    )
