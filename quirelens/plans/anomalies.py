"""Queries: metadata of wrong form, by source."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirelens.operators import anomalies as A
from quirelens.operators import fields as M
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query


def _records(spark, d):
    rows = T._documents(spark, d, "documents").select("source", "volume_id", T.metadata_v2().alias("metadata"))
    return M.parse_metadata(rows)


#: Path, reason, type found, and which records the derived metadata gives that form.
FORMS = [
    ("language", "neither text nor list", "BIGINT", "d % 3 = 2"), ("lastRightsUpdateDate", "empty", "STRING", "d % 3 = 2"),
    ("pubDate", "not a whole number", "STRING", "d % 4 = 2"), ("pubDate", "not a whole number", "DECIMAL", "d % 4 = 3"),
    ("contributor", "no id", "OBJECT", "d % 5 = 2"), ("contributor[]", "no id", "OBJECT", "d % 5 = 3"),
    ("type[0]", "unexpected value", "STRING", "d % 4 = 2"), ("type", "unexpected length", "ARRAY", "d % 4 = 3"),
    ("sourceInstitution.type", "unexpected value", "STRING", "d % 6 = 0"),
    ("mainEntityOfPage", "unexpected length", "ARRAY", "d % 4 = 2"), ("mainEntityOfPage[0]", "unexpected value", "STRING", "d % 4 = 3"),
]
FOUND = " UNION ALL ".join(f"SELECT source, vid, '{p}' AS path, '{r}' AS reason, '{t}' AS found FROM m WHERE d % 29 <> 0 AND {c}" for p, r, t, c in FORMS)


@query(
    "metadata_anomalies",
    f"""WITH m AS (SELECT source, doc_id AS d, {Q.DOC_ID} AS vid FROM documents),
 a AS ({FOUND} UNION ALL SELECT source, vid, 'metadata', 'missing', NULL FROM m WHERE d % 29 = 0)
 SELECT source, path, reason, found, count(*) AS n, min(vid) AS example FROM a GROUP BY source, path, reason, found""",
)
def metadata_anomalies(spark, d):
    return A.anomaly_report(_records(spark, d), "source")


#: Member, and its type by a remainder of the id; NULL where it is missing.
TYPES = [
    ("accessProfile", "['STRING', 'STRING', 'VOID', NULL][d % 4 + 1]"), ("accessRights", "'STRING'"), ("id", "'STRING'"), ("title", "'STRING'"),
    ("dateCreated", "'BIGINT'"), ("lastRightsUpdateDate", "['BIGINT', 'STRING', 'STRING'][d % 3 + 1]"),
    ("pubDate", "['BIGINT', 'STRING', 'STRING', 'DECIMAL'][d % 4 + 1]"), ("schemaVersion", "'STRING'"),
    ("typeOfResource", "CASE WHEN d % 5 <> 0 THEN 'STRING' END"), ("language", "['STRING', 'ARRAY', 'BIGINT'][d % 3 + 1]"),
    ("oclc", "['STRING', 'ARRAY', 'ARRAY', 'VOID'][d % 4 + 1]"), ("genre", "['STRING', 'ARRAY', 'STRING', 'ARRAY'][d % 4 + 1]"),
    ("contributor", "['OBJECT', 'ARRAY', 'OBJECT', 'ARRAY', NULL][d % 5 + 1]"), ("publisher", "'OBJECT'"), ("pubPlace", "'OBJECT'"),
    ("type", "'ARRAY'"), ("sourceInstitution", "'OBJECT'"), ("mainEntityOfPage", "'ARRAY'"),
]
TYPED = " UNION ALL ".join(f"SELECT source, '{n}' AS member, {t} AS found FROM m" for n, t in TYPES)


@query(
    "metadata_types",
    f"""WITH m AS (SELECT source, doc_id AS d FROM documents WHERE doc_id % 29 <> 0)
 SELECT source, member, found, count(*) AS n FROM ({TYPED}) WHERE found IS NOT NULL GROUP BY source, member, found""",
)
def metadata_types(spark, d):
    return A.type_report(_records(spark, d).filter(F.col("metadata").isNotNull()), "source")
