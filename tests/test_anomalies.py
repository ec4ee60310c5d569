"""Every wrong form of metadata, by hand."""

import json

import pytest
from pyspark.sql import functions as F

from quirelens.operators import anomalies as A
from quirelens.settings import ORGANIZATION_TYPE

FINE = {
    "accessProfile": "open", "accessRights": "pd", "id": "http://h/1", "title": "t", "dateCreated": 20240115, "lastRightsUpdateDate": "20180917",
    "pubDate": "1911", "schemaVersion": "s", "typeOfResource": None, "language": ["por"], "oclc": "1", "genre": [],
    "contributor": [{"id": "p"}], "publisher": {"id": "q"}, "type": ["DataFeedItem", "Book"],
    "sourceInstitution": {"name": "LMN", "type": ORGANIZATION_TYPE}, "mainEntityOfPage": ["https://catalog.example.org/Record/1"],
}


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, []),
        ({"title": 3}, [("title", "not text", "BIGINT")]),
        ({"schemaVersion": ["s"]}, [("schemaVersion", "not text", "ARRAY")]),
        ({"pubDate": "19uu"}, [("pubDate", "not a whole number", "STRING")]),
        ({"pubDate": 1911.5}, [("pubDate", "not a whole number", "DECIMAL")]),
        ({"pubDate": ""}, [("pubDate", "empty", "STRING")]),
        ({"pubDate": [1911]}, [("pubDate", "not a whole number", "ARRAY")]),
        ({"language": {"a": 1}}, [("language", "neither text nor list", "OBJECT")]),
        ({"language": ["por", 3]}, [("language[]", "not text", "BIGINT")]),
        ({"contributor": "p"}, [("contributor", "neither object nor list", "STRING")]),
        ({"contributor": {"name": "n"}}, [("contributor", "no id", "OBJECT")]),
        ({"contributor": [{"id": "p"}, {"name": "n"}]}, [("contributor[]", "no id", "OBJECT")]),
        ({"contributor": [{"id": "p"}, "n"]}, [("contributor[]", "not an object", "STRING")]),
        ({"type": None}, [("type", "missing", None)]),
        ({"type": "Book"}, [("type", "not a list", "STRING")]),
        ({"type": ["DataFeedItem"]}, [("type", "unexpected length", "ARRAY")]),
        ({"type": ["Other", "Book"]}, [("type[0]", "unexpected value", "STRING")]),
        ({"sourceInstitution": None}, [("sourceInstitution", "missing", None)]),
        ({"sourceInstitution": "LMN"}, [("sourceInstitution", "not an object", "STRING")]),
        ({"sourceInstitution": {"type": "x"}}, [("sourceInstitution.type", "unexpected value", "STRING")]),
        ({"mainEntityOfPage": ["a", "b"]}, [("mainEntityOfPage", "unexpected length", "ARRAY"), ("mainEntityOfPage[0]", "unexpected value", "STRING")]),
        ({"mainEntityOfPage": None}, [("mainEntityOfPage", "missing", None)]),
    ],
)
def test_every_form(spark, change, want):
    made = spark.createDataFrame([(json.dumps({**FINE, **change}),)], "m string").select(F.try_parse_json("m").alias("metadata"))
    got = made.select(A.anomalies(F.col("metadata")).alias("a")).first().a
    assert [tuple(a) for a in got] == want


def test_report_counts_by_group(spark):
    made = [("s1", "v2", json.dumps({**FINE, "title": 1})), ("s1", "v1", json.dumps({**FINE, "title": 2})), ("s2", "v3", None), ("s2", "v4", json.dumps(FINE))]
    rows = spark.createDataFrame(made, "source string, volume_id string, m string").withColumn("metadata", F.try_parse_json("m"))
    got = sorted(map(tuple, A.anomaly_report(rows, "source").collect()), key=str)
    assert got == [("s1", "title", "not text", "BIGINT", 2, "v1"), ("s2", "metadata", "missing", None, 1, "v3")]
    types = {(r.member, r.found): r.n for r in A.type_report(rows, "source").filter("source = 's1'").collect()}
    assert types[("title", "BIGINT")] == 2 and types[("typeOfResource", "VOID")] == 2 and types[("language", "ARRAY")] == 2
