"""Damaged records: what is reported and what is kept."""

import json

import pytest

from quirelens.operators import docstore
from quirelens.operators import explode as X
from quirelens.sources import records


def zone(tokens, **chars):
    return {"tokenPosCount": tokens, **chars}


def record(key, pages, count=None, **more):
    return key, json.dumps({"id": key, "features": {"pageCount": len(pages) if count is None else count, "pages": pages}, **more})


GOOD = {"seq": "1", "calculatedLanguage": "en", "body": zone({"x": {"NN": 1}})}
RAW = [
    record("a.good", [GOOD, None, {"body": None}, {"body": {"tokenPosCount": None, "beginCharCounts": None}}]),
    record("a.page", [GOOD, 7, GOOD, "text", [GOOD], True]),
    record("a.zone", [{**GOOD, "header": 3, "footer": [1]}, {"body": "none"}]),
    record("a.maps", [{"body": zone([1], beginCharCounts="b", endCharCount={"z": 4})}]),
    record("a.tags", [{"body": zone({"bad": 3, "none": None, "ok": {"NN": 2}, "text": "x"})}, GOOD]),
    record("a.odd", [{"body": zone({"x": {"NN": "many", "VB": 2}, "y": {"NN": 1.5}}, beginCharCounts={"a": 1.5, "b": 2, "c": "3"})}]),
    record("a.past", [GOOD, 7], 1),
    ("a.twice", '{"id": "a.twice", "features": {"pageCount": 2, "pages": [{"seq": "1", "seq": "2", "body": {"tokenPosCount": {"x": {"NN": 1}}}}, {"body": 4}]}}'),
    ("a.cut", '{"id": "a.cut", "features": {"pageCount": 2'),
    ("a.none", '{"id": "a.none", "features": {"pageCount": 2, "pages": 3}}'),
    ("a.null", None),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, "key string, json string")


def test_every_fault_is_reported(raw):
    got = sorted(map(tuple, records.record_faults(raw).collect()), key=str)
    no, odd = "not an object", "not a whole number"
    assert got == sorted([
        ("a.page", 1, None, no), ("a.page", 3, None, no), ("a.page", 4, None, no), ("a.page", 5, None, no),
        ("a.zone", 0, "header", no), ("a.zone", 0, "footer", no), ("a.zone", 1, "body", no),
        ("a.maps", 0, "body.tokenPosCount", no), ("a.maps", 0, "body.beginCharCounts", no),
        ("a.tags", 0, "body.tokenPosCount.bad", no), ("a.tags", 0, "body.tokenPosCount.text", no),
        ("a.odd", 0, "body.tokenPosCount.x.NN", odd), ("a.odd", 0, "body.tokenPosCount.y.NN", odd), ("a.odd", 0, "body.beginCharCounts.a", odd),
        ("a.twice", None, "features.pages", "repeated names"),
        ("a.cut", None, None, "unparsable"), ("a.none", None, None, "no pages"), ("a.null", None, None, "unparsable"),
    ], key=str)


def test_nothing_good_is_lost(raw):
    good, bad = records.parse_volumes(raw)
    assert sorted(r.key for r in bad.collect()) == ["a.cut", "a.none", "a.null"]
    pages = X.explode_pages(good)
    tokens = {}
    for r in X.explode_tokens(pages).collect():
        tokens.setdefault(r.page_id, {})[r.token] = sorted(r.pos_tags)
    x = {"x": ["NN"]}
    assert tokens == {
        "a.good.page-000000": x, "a.page.page-000000": x, "a.page.page-000002": x, "a.zone.page-000000": x,
        "a.tags.page-000000": {"bad": [], "none": [], "ok": ["NN"], "text": []}, "a.tags.page-000001": x,
        "a.odd.page-000000": {"x": ["NN", "VB"], "y": ["NN"]}, "a.past.page-000000": x, "a.twice.page-000000": x,
    }
    assert pages.filter("volume_id = 'a.page'").count() == 2  # what is no object is no page


def test_zones_and_stored_records_of_parsed_counts(raw):
    pages = X.explode_pages(records.parse_volumes(raw)[0])
    zones = {(r.page_id, r.count_map, r.key): r.n for r in X.explode_zones(pages).filter("volume_id in ('a.odd', 'a.maps')").collect()}
    assert zones == {
        ("a.odd.page-000000", "tokenPosCount", "x"): 2, ("a.odd.page-000000", "tokenPosCount", "y"): 0,
        ("a.odd.page-000000", "beginCharCounts", "a"): None, ("a.odd.page-000000", "beginCharCounts", "b"): 2,
        ("a.odd.page-000000", "beginCharCounts", "c"): 3, ("a.maps.page-000000", "endCharCount", "z"): 4,
    }
    stored = docstore.safe_zone_maps(pages).filter("volume_id = 'a.odd'").first()
    assert stored.body.tokenPosCount == {"x": {"NN": None, "VB": 2}, "y": {"NN": None}}
    assert stored.body.beginCharCounts == {"a": None, "b": 2, "c": 3}


def test_strict_fails_on_damaged_pages(spark, raw):
    for key in ("a.page", "a.tags", "a.cut"):
        strict, _ = records.parse_volumes(raw.filter(f"key = '{key}'"), strict=True)
        with pytest.raises(Exception, match="bad record"):
            strict.collect()
    fine, _ = records.parse_volumes(raw.filter("key = 'a.good'"), strict=True)
    assert fine.count() == 1


def test_languages_of_damaged_version_15_records(spark):
    pages = [{"languages": [{"ko": "0.7"}, {"ja": "0.3"}], "body": zone({"x": {"NN": 1}})}, 3, {"languages": 5, "body": zone({"y": {"NN": 1}})}]
    raw = spark.createDataFrame([record("a.v", pages)], "key string, json string")
    good, _ = records.parse_volumes(raw, "1.5")
    assert sorted((r.page_index, r.langs) for r in X.explode_pages(good).collect()) == [(0, ["ko", "ja"]), (2, [])]
    assert [tuple(r) for r in records.record_faults(raw, "1.5").collect()] == [("a.v", 1, None, "not an object")]
