"""Shared parts of the SQL checks: the derived tables, written again in SQL."""

from quirelens.settings import V15_STRINGS

TOK = r"[\p{L}\p{M}\p{N}_]+(?:[''’.][\p{L}\p{M}\p{N}_]+)*"
DOC_ID = "CASE WHEN doc_id % 2 = 0 THEN 'qlib.ark:/77001/t' || doc_id ELSE source || '.' || doc_id END"


def pages_cte(table: str = "documents") -> str:
    source = table
    if table == "benchmark":
        source = "(SELECT item_id AS doc_id, text, 'en' AS lang, 'bench' AS source FROM benchmark)"
    return f"""
base AS (SELECT *, {DOC_ID} AS volume_id, string_split(text, chr(10)) AS lines FROM {source}),
vol AS (SELECT *, len(lines) AS n_lines,
  len(lines) + CASE right(text, 1) WHEN '.' THEN 0 WHEN '!' THEN 1 ELSE -1 END AS page_count FROM base),
ent AS (SELECT volume_id, lang, page_count, i - 1 AS page_index,
  list_distinct(regexp_extract_all(lines[i], '[^ \\t\\r]+')) AS ks
  FROM (SELECT *, unnest(range(1, n_lines + 1)) AS i FROM vol)),
ent2 AS (SELECT *, len(ks) AS n, length(array_to_string(ks, '')) AS w FROM ent),
pg AS (SELECT volume_id, printf('%s.page-%06d', volume_id, page_index) AS page_id, page_index, ks, lang,
  CASE WHEN n IN (2, 3) THEN NULL ELSE lang END AS plang, n > 1 AS has_body, n > 1 AND NOT (n = 2 AND w <= 8) AS has_tokens
  FROM ent2 WHERE page_index < page_count AND NOT (n = 1 AND w <= 7)),
ix AS (SELECT * FROM pg WHERE has_tokens)"""


TOKENS = """,
tok AS (SELECT volume_id, page_id, plang, lang, unnest(ks) AS token FROM ix),
tokt AS (SELECT *, CASE WHEN length(token) = 1 THEN []::VARCHAR[] ELSE list_concat(
  [['NN', 'VB', 'JJ', 'QQ'][length(token) % 4 + 1]],
  CASE WHEN regexp_matches(token, '^\\p{Lu}') THEN ['NNP'] ELSE []::VARCHAR[] END) END AS tags FROM tok),
tagged AS (SELECT page_id, plang, lang, token, unnest(tags) AS tag FROM tokt)"""

TERMS = f""",
trm AS (SELECT page_id, plang, tags, unnest(regexp_extract_all(token, '{TOK}')) AS term FROM tokt)"""

POS_MAP = """,
pos_map(lang, tag, upos) AS (VALUES ('en', 'NN', 'NOUN'), ('en', 'NNP', 'NOUN'), ('en', 'VB', 'VERB'), ('en', 'JJ', 'ADJ'),
  ('de', 'NN', 'NOUN'), ('de', 'VB', 'VERB'))"""

DICT = f""",
dict AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{TOK}'))) AS word FROM benchmark)"""

CONCEPTS = f"""con AS (SELECT 'vol' || conv_id AS document,
  CASE WHEN conv_id % 2 = 0 THEN 'qlib.ark:/vol' || conv_id ELSE 'vol' || conv_id END AS volume_id,
  CASE WHEN conv_id % 2 = 0 THEN 'qlib.ark:' ELSE 'vol' || conv_id END AS collection, turn, role,
  'vol' || conv_id || '/' || CASE WHEN length(text) < 40 THEN 'p' || turn ELSE printf('%06d', turn) END || '.txt' AS source_page,
  CASE WHEN length(text) < 40 THEN NULL ELSE printf('page-%06d', turn) END AS page_id,
  list_filter(regexp_extract_all(text, '{TOK}'), lambda w: length(w) > 8) AS vals FROM conversations)"""


def tokens(table: str = "documents") -> str:
    return "WITH " + pages_cte(table) + TOKENS


def terms(table: str = "documents") -> str:
    return tokens(table) + TERMS


# Field names made from (name, mode, vals): one row per suffix.
EXPAND = """, shape(mode, lvl, suffix, kind) AS (VALUES
  ('string', 'volume', '_t', 'single'), ('string', 'volume', '_s', 'single'),
  ('string', 'page', '_txt', 'single'), ('string', 'page', '_htrcstring', 'single'),
  ('uri', 'volume', '_s', 'single'), ('uri', 'page', '_htrcstring', 'single'),
  ('multi', 'volume', '_t', 'multi'), ('multi', 'volume', '_ss', 'multi'),
  ('multi', 'page', '_txt', 'multi'), ('multi', 'page', '_htrcstrings', 'multi'),
  ('uris', 'volume', '_ss', 'multi'), ('uris', 'page', '_htrcstrings', 'multi'),
  ('int', 'volume', '_i', 'int'), ('int', 'page', '_i', 'int')),
fld AS (SELECT doc_id, lvl, CASE lvl WHEN 'page' THEN 'volume' ELSE '' END || name || suffix AS field, kind, vals
  FROM entries JOIN shape USING (mode))"""

FIELD_ROWS = "SELECT doc_id, field, kind, len(vals) AS n_values, array_to_string(vals, '|') AS joined FROM fld"

META2 = f"""meta AS (SELECT {DOC_ID} AS vid, doc_id AS d, n_chars AS n, source, lang, 1800 + doc_id % 200 AS yr
  FROM documents WHERE doc_id % 29 <> 0)"""
PERSON = "'http://id.loc.gov/ontologies/bibframe/Person'"
BIO, DOC = "'http://id.loc.gov/vocabulary/marcgt/ess'", "'http://id.loc.gov/vocabulary/marcgt/fic'"
ORG = "'http://id.loc.gov/ontologies/bibframe/Organization'"

# Expected entries per group of the version 2 metadata: (doc_id, name, mode, vals).
ENTRIES2 = {
    "meta2_strings": """
 SELECT vid AS doc_id, 'accessProfile' AS name, 'string' AS mode, [CASE d % 4 WHEN 0 THEN 'google' ELSE 'open' END] AS vals FROM meta WHERE d % 4 < 2
 UNION ALL SELECT vid, 'accessRights', 'string', [CASE d % 2 WHEN 0 THEN 'pd' ELSE 'ic' END] FROM meta
 UNION ALL SELECT vid, 'htid', 'string', ['http://hdl.example.net/2027/' || vid] FROM meta
 UNION ALL SELECT vid, 'title', 'string', [source || ' vol. ' || d || '; a "new" edition'] FROM meta""",
    "meta2_ints": """
 SELECT vid AS doc_id, 'dateCreated' AS name, m.mode, [CAST(20200000 + d % 1000 AS VARCHAR)] AS vals FROM meta, (VALUES ('int'), ('string')) m(mode)
 UNION ALL SELECT vid, 'lastRightsUpdateDate', m.mode, ['20180917'] FROM meta, (VALUES ('int'), ('string')) m(mode) WHERE d % 3 < 2
 UNION ALL SELECT vid, 'pubDate', m.mode, [CAST(yr AS VARCHAR)] FROM meta, (VALUES ('int'), ('string')) m(mode) WHERE d % 4 <> 2
 UNION ALL SELECT vid, 'pubDate', 'string', ['18uu'] FROM meta WHERE d % 4 = 2""",
    "meta2_uris": """
 SELECT vid AS doc_id, 'schemaVersion' AS name, 'uri' AS mode, ['https://schemas.example.org/metadata_v_3.0'] AS vals FROM meta
 UNION ALL SELECT vid, 'typeOfResource', 'uri', ['http://id.loc.gov/ontologies/bibframe/Text'] FROM meta WHERE d % 5 <> 0""",
    "meta2_multi": """
 SELECT vid AS doc_id, 'language' AS name, 'multi' AS mode, CASE d % 3 WHEN 0 THEN [lang] ELSE [lang, 'la'] END AS vals FROM meta WHERE d % 3 < 2
 UNION ALL SELECT vid, 'oclc', 'multi', CASE d % 4 WHEN 0 THEN [CAST(n AS VARCHAR)] WHEN 1 THEN [CAST(n AS VARCHAR), CAST(n + 1 AS VARCHAR)] ELSE []::VARCHAR[] END FROM meta WHERE d % 4 < 3""",
    "meta2_multi_uri": f"""
 SELECT vid AS doc_id, 'genre' AS name, 'uris' AS mode, CASE d % 4 WHEN 0 THEN [{DOC}] WHEN 1 THEN [{BIO}] ELSE [{BIO}, {DOC}] END AS vals FROM meta WHERE d % 4 <> 2""",
    "meta2_id_name_type": f"""
 SELECT vid AS doc_id, 'contributorId' AS name, 'uris' AS mode, ['http://www.viaf.example/' || CASE d % 5 WHEN 3 THEN n ELSE d END] AS vals FROM meta WHERE d % 5 IN (0, 1, 3)
 UNION ALL SELECT vid, 'contributorName', 'multi', ['Author ' || d] FROM meta WHERE d % 5 IN (0, 1, 3)
 UNION ALL SELECT vid, 'contributorType', 'uris', CASE d % 5 WHEN 1 THEN [{PERSON}, {PERSON}] ELSE [{PERSON}] END FROM meta WHERE d % 5 IN (0, 1, 3)
 UNION ALL SELECT vid, 'publisherId', 'uris', ['http://lod.example.org/' || source] FROM meta
 UNION ALL SELECT vid, 'publisherName', 'multi', ['House of ' || source] FROM meta
 UNION ALL SELECT vid, 'publisherType', 'uris', [{ORG}] FROM meta
 UNION ALL SELECT vid, 'pubPlaceId', 'uris', ['http://id.loc.gov/vocabulary/countries/' || lang] FROM meta
 UNION ALL SELECT vid, 'pubPlaceName', 'multi', ['Land'] FROM meta WHERE d % 2 = 0
 UNION ALL SELECT vid, 'pubPlaceType', 'uris', ['http://id.loc.gov/ontologies/bibframe/Place'] FROM meta""",
    "meta2_bibformat": """
 SELECT vid AS doc_id, 'bibliographicFormat' AS name, 'string' AS mode, [CASE d % 4 WHEN 0 THEN 'Book' ELSE 'Serial' END] AS vals FROM meta WHERE d % 4 < 2""",
    "meta2_source_inst": """
 SELECT vid AS doc_id, 'sourceInstitution' AS name, 'string' AS mode, [upper(source)] AS vals FROM meta WHERE d % 6 <> 0""",
    "meta2_catalog_record": """
 SELECT vid AS doc_id, 'mainEntityOfPageCatalogRecord' AS name, 'uri' AS mode, ['https://catalog.example.org/Record/' || d] AS vals FROM meta WHERE d % 4 < 3""",
}

V15_NAMES = ", ".join(f"('{n}')" for n in V15_STRINGS)
META15 = f"meta AS (SELECT {DOC_ID} AS vid, doc_id AS d, n_chars AS n, source, lang FROM documents)"
ENTRIES15 = {
    "meta15_single": """
 SELECT vid AS doc_id, k.name, 'string' AS mode, [CASE k.name WHEN 'language' THEN CASE lang WHEN 'es' THEN '' ELSE lang END ELSE k.name || ' ' || vid END] AS vals
 FROM meta, """ + f"(VALUES {V15_NAMES})" + """ k(name)""",
    "meta15_multi": """
 SELECT vid AS doc_id, 'oclc' AS name, 'multi' AS mode, CASE d % 2 WHEN 0 THEN [CAST(n AS VARCHAR)] ELSE []::VARCHAR[] END AS vals FROM meta
 UNION ALL SELECT vid, k.name, 'multi', []::VARCHAR[] FROM meta, (VALUES ('isbn'), ('issn')) k(name)
 UNION ALL SELECT vid, 'lccn', 'multi', ['ca ' || d] FROM meta
 UNION ALL SELECT vid, 'genre', 'multi', ['fiction', 'not fiction'] FROM meta
 UNION ALL SELECT vid, 'names', 'multi', ['Author ' || d, source || ' Collection '] FROM meta""",
    "meta15_classification": """
 SELECT vid AS doc_id, 'classification_lcc' AS name, 'multi' AS mode, ['PR' || d] AS vals FROM meta WHERE d % 3 < 2
 UNION ALL SELECT vid, 'classification_ddc', 'multi', ['8' || d, '9'] FROM meta WHERE d % 3 = 1""",
}


def entries(meta: str, selects: list[str]) -> str:
    return meta + ", entries AS (" + " UNION ALL ".join(f"SELECT * FROM ({s})" for s in selects) + ")" + EXPAND


def field_check(key: str) -> str:
    meta, group = (META2, ENTRIES2) if key in ENTRIES2 else (META15, ENTRIES15)
    return "WITH " + entries(meta, [group[key]]) + " " + FIELD_ROWS
