"""Hand-written metadata and pages: terms, tags, fields, documents, concepts, dictionaries."""

import json

import pytest
from pyspark.sql import functions as F

from quirelens.functions import text
from quirelens.operators import concepts as C
from quirelens.operators import dictionary as B
from quirelens.operators import documents as D
from quirelens.operators import fields as M
from quirelens.operators import lookup
from quirelens.operators import pos as P
from quirelens.operators import terms as W

ORG = "http://id.loc.gov/ontologies/bibframe/Organization"
PERSON = "http://id.loc.gov/ontologies/bibframe/Person"


def rows(frame, *names):
    return sorted(tuple(r[n] for n in names) for r in frame.select(*names).collect())


def volume_doc(spark, meta, version="2"):
    made = spark.createDataFrame([("v", json.dumps(meta))], "volume_id string, metadata string")
    command = json.loads(D.volume_documents(M.parse_metadata(made), version).first()["json"])
    assert set(command) == {"add"} and command["add"]["commitWithin"] == 120000
    return command["add"]["doc"]


def test_v2_sample_record(spark):
    doc = volume_doc(
        spark,
        {
            "accessProfile": "google", "accessRights": "pd", "dateCreated": 20231102, "enumerationChronology": "no. 3",
            "contributor": {"id": "http://people.example.org/44", "name": "Okafor, Ines", "type": PERSON},
            "genre": "http://id.loc.gov/vocabulary/marcgt/fic", "id": "http://hdl.example.net/5/xyz.1", "language": "eng",
            "lastRightsUpdateDate": 20180917, "oclc": "90417355", "pubDate": 1911,
            "mainEntityOfPage": ["https://catalog.example.org/Record/771", "http://x", "http://y"],
            "pubPlace": {"id": "http://id.loc.gov/vocabulary/countries/pt", "name": "Portugal", "type": "http://t/Place"},
            "publisher": {"id": "http://p", "name": 'Casa "Azul"', "type": ORG},
            "schemaVersion": "https://s", "sourceInstitution": {"name": "LMN", "type": ORG},
            "title": "Rivers {and} bridges]", "type": ["DataFeedItem", "Book"], "typeOfResource": "http://r",
        },
    )
    assert doc == {
        "id": "v", "accessProfile_t": "google", "accessProfile_s": "google", "accessRights_t": "pd", "accessRights_s": "pd",
        "htid_t": "http://hdl.example.net/5/xyz.1", "htid_s": "http://hdl.example.net/5/xyz.1",
        "title_t": "Rivers {and} bridges]", "title_s": "Rivers {and} bridges]",
        "dateCreated_i": 20231102, "dateCreated_t": "20231102", "dateCreated_s": "20231102",
        "lastRightsUpdateDate_i": 20180917, "lastRightsUpdateDate_t": "20180917", "lastRightsUpdateDate_s": "20180917",
        "pubDate_i": 1911, "pubDate_t": "1911", "pubDate_s": "1911", "schemaVersion_s": "https://s", "typeOfResource_s": "http://r",
        "language_t": ["eng"], "language_ss": ["eng"], "oclc_t": ["90417355"], "oclc_ss": ["90417355"],
        "genre_ss": ["http://id.loc.gov/vocabulary/marcgt/fic"], "contributorId_ss": ["http://people.example.org/44"],
        "contributorName_t": ["Okafor, Ines"], "contributorName_ss": ["Okafor, Ines"], "contributorType_ss": [PERSON],
        "publisherId_ss": ["http://p"], "publisherName_t": ['Casa "Azul"'], "publisherName_ss": ['Casa "Azul"'], "publisherType_ss": [ORG],
        "pubPlaceId_ss": ["http://id.loc.gov/vocabulary/countries/pt"], "pubPlaceName_t": ["Portugal"],
        "pubPlaceName_ss": ["Portugal"], "pubPlaceType_ss": ["http://t/Place"],
        "bibliographicFormat_t": "Book", "bibliographicFormat_s": "Book", "sourceInstitution_t": "LMN", "sourceInstitution_s": "LMN",
        "mainEntityOfPageCatalogRecord_s": "https://catalog.example.org/Record/771",
    }


@pytest.mark.parametrize(
    "meta, want",
    [
        ({"pubDate": "1911"}, {"pubDate_i": 1911, "pubDate_t": "1911", "pubDate_s": "1911"}),
        ({"pubDate": "18uu"}, {"pubDate_t": "18uu", "pubDate_s": "18uu"}),
        ({"pubDate": ""}, {}),
        ({"pubDate": None}, {}),
        ({"pubDate": 1911.9}, {"pubDate_i": 1911, "pubDate_t": "1911", "pubDate_s": "1911"}),
        ({"pubDate": " 1911"}, {"pubDate_t": " 1911", "pubDate_s": " 1911"}),
        ({"language": ["eng", "fre"]}, {"language_t": ["eng", "fre"], "language_ss": ["eng", "fre"]}),
        ({"language": []}, {"language_t": [], "language_ss": []}),
        ({"language": {"a": 1}}, {}),
        ({"genre": "urn:uuid:1"}, {}),
        ({"genre": ["urn:uuid:1", "http://g"]}, {"genre_ss": ["http://g"]}),
        ({"contributor": {"name": "n", "type": "t"}}, {}),
        ({"contributor": {"id": "i", "name": "n"}}, {"contributorId_ss": ["i"], "contributorName_t": ["n"], "contributorName_ss": ["n"]}),
        (
            {"contributor": [{"id": "urn:uuid:1", "type": "t"}, {"id": "i", "name": "n", "type": "t"}]},
            {"contributorId_ss": ["i"], "contributorName_t": ["n"], "contributorName_ss": ["n"], "contributorType_ss": ["t", "t"]},
        ),
        ({"type": ["Other", "Book"]}, {}),
        ({"type": ["DataFeedItem"]}, {}),
        ({"sourceInstitution": {"name": "LMN", "type": "http://other"}}, {}),
        ({"mainEntityOfPage": ["http://catalog.example.org/other"]}, {}),
        ({"mainEntityOfPage": ["https://catalog.example.org/Record/1", "b"]}, {"mainEntityOfPageCatalogRecord_s": "https://catalog.example.org/Record/1"}),
    ],
)
def test_v2_forms(spark, meta, want):
    assert volume_doc(spark, meta) == {"id": "v", **want}


def test_v15_record(spark):
    meta = {
        "title": "A winter atlas", "language": "eng", "sourceInstitutionRecordNumber": "X-19", "enumerationChronology": "part b",
        "governmentDocument": False, "isbn": [], "names": ["Ferreira ", "Mo"], "classification": {"lcc": ["QK881"]},
    }
    assert volume_doc(spark, meta, "1.5") == {
        "id": "v", "title_t": "A winter atlas", "title_s": "A winter atlas", "language_t": "eng", "language_s": "eng",
        "sourceInstitutionRecordNumber_t": "X-19", "sourceInstitutionRecordNumber_s": "X-19", "isbn_t": [], "isbn_ss": [],
        "names_t": ["Ferreira ", "Mo"], "names_ss": ["Ferreira ", "Mo"],
        "classification_lcc_t": ["QK881"], "classification_lcc_ss": ["QK881"],
    }


def test_volume_without_metadata_gives_no_document(spark):
    made = spark.createDataFrame([("v", None), ("w", "{}")], "volume_id string, metadata string")
    assert rows(D.volume_documents(M.parse_metadata(made)), "doc_id") == [("w",)]


@pytest.mark.parametrize(
    "token, want",
    [
        ("Don't", ["Don't"]), ("3.14", ["3.14"]), ("well-known", ["well", "known"]), ("foo_bar", ["foo_bar"]), ("--", []),
        ("é", ["é"]), ("e\u0301a", ["e\u0301a"]), ("日本語", ["日本語"]), ("l’eau,", ["l’eau"]), ("end.", ["end"]),
    ],
)
def test_word_breaks(spark, token, want):
    assert spark.range(1).select(text.words(F.lit(token))).first()[0] == want


TOKENS = "page_id string, langs array<string>, token string, pos_tags array<string>"


def test_dictionary_filter_has_two_branches(spark):
    words = spark.createDataFrame([("well-known",), ("mill",), ("Upper",)], "word string")
    made = spark.createDataFrame(
        [("p", ["en"], t, ["NN"]) for t in ("well-known", "Wind-Mill", "Upper", "none", "MILL")], TOKENS
    )
    raw = W.terms(made, tokenize=False)
    want = [("known",), ("mill",), ("mill",), ("upper",), ("well",)]
    assert rows(W.dictionary_filter(raw, words), "term") == want
    assert rows(W.dictionary_filter(raw, words, small=False), "term") == want
    assert rows(W.page_terms(made), "term") == [("known",), ("mill",), ("mill",), ("none",), ("upper",), ("well",), ("wind",)]


def pos_map(spark):
    made = [("en", "NN", "NOUN"), ("en", "VB", "VERB"), ("de", "NN", "NOUN"), ("de", "XY", "X")]
    return spark.createDataFrame(made, "lang string, tag string, upos string")


PAIRS = [
    (["fr", "en"], "NN", "en", "NOUN", False), (["en", "de"], "ZZ", "en", "X", True), (["fr", "en"], "ZZ", "fr", None, False),
    (["fr"], "NN", "fr", None, False), (["en", "de"], "XY", "de", "X", False), ([], "NN", None, None, False),
]


@pytest.mark.parametrize("max_embed", [100, 2])
def test_pos_pair(spark, max_embed):
    made = spark.createDataFrame([p[:2] for p in PAIRS] * 3, "langs array<string>, tag string")
    got = P.pos_pair(made, pos_map(spark), max_embed).collect()
    assert sorted(map(repr, ((r["langs"], r["tag"], r["lang"], r["upos"], r["defaulted"]) for r in got))) == sorted(map(repr, PAIRS * 3))


def test_missing_pos_does_not_count_mapped_x(spark):
    made = spark.createDataFrame([p[:2] for p in PAIRS], "langs array<string>, tag string")
    assert rows(P.missing_pos(made, pos_map(spark)), "lang_tag", "n") == [("en:ZZ", 1)]


def test_homogeneous_fallbacks(spark):
    made = spark.createDataFrame([(["en"], t) for t in ("NN", "UKN", "ZZ")], "langs array<string>, tag string")
    one_map = P.merge_tag_maps(pos_map(spark))
    assert rows(P.pos_pair_homogeneous(made, one_map), "tag", "lang", "upos") == [("NN", "en", "NOUN"), ("UKN", "en", "X"), ("ZZ", "en", None)]
    assert rows(P.pos_checked_homogeneous(made, one_map), "tag", "upos") == [("NN", "NOUN"), ("UKN", ""), ("ZZ", "X")]


def test_lookup_on_one_hot_key(spark):
    made = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    side = spark.createDataFrame([("hot", 1), ("1", 2)], "k string, v int")
    for small in (True, False):
        got = lookup.left_lookup(made, side, ["k"], small)
        assert got.count() == 3000 and got.filter("v = 1").count() == 1000 and got.filter("v = 2").count() == 1
    assert lookup.fits_broadcast(side) and not lookup.fits_broadcast(side, max_rows=1) and not lookup.fits_broadcast(side, max_bytes=10)


PAGE = "volume_id string, page_id string, langs array<string>, terms array<struct<term: string, pos_tags: array<string>>>"


@pytest.mark.parametrize("max_embed", [100, 2])
def test_text_fields(spark, max_embed):
    made = spark.createDataFrame(
        [
            ("v", "p1", ["en"], [("run", ["NN", "VB"]), ("odd", ["ZZ"]), ("bare", [])]),
            ("v", "p2", [], [("x", ["NN"])]),
            ("v", "p3", ["fr"], [("y", ["NN"])]),
            ("v", "p4", ["en"], []),
        ],
        PAGE,
    )
    got = {
        r["page_id"]: {f["field"]: sorted(f["values"]) for f in r["text_fields"]}
        for r in D.text_fields(made, pos_map(spark), max_embed).collect()
    }
    assert got == {
        "p1": {
            "en_NOUN_htrctokentext": ["run"], "en_VERB_htrctokentext": ["run"], "en_X_htrctokentext": ["odd"],
            "en_htrctokentext": ["odd", "run", "run"], "alllangs_htrctokentext": ["odd", "run", "run"],
        },
        "p2": {}, "p3": {"fr_htrctokentext": ["y"], "alllangs_htrctokentext": ["y"]}, "p4": {},
    }
    flags = made.select("page_id", F.size(D.no_text_flag(F.col("terms"))).alias("n"))
    assert rows(flags, "page_id", "n") == [("p1", 0), ("p2", 0), ("p3", 0), ("p4", 1)]


def test_page_document_without_metadata(spark):
    zone = "struct<tokenPosCount: map<string, map<string, int>>>"
    ddl = f"volume_id string, metadata string, page_count int, pages array<struct<calculatedLanguage: string, body: {zone}>>"
    made = spark.createDataFrame([("v", None, 2, [("en", ({"--": {"NN": 1}},)), (None, ({"A-b": {"NN": 1}},))])], ddl)
    got = [json.loads(r["json"])["add"]["doc"] for r in D.page_documents(M.parse_metadata(made), pos_map(spark)).collect()]
    assert sorted(got, key=lambda d: d["id"]) == [
        {"id": "v.page-000000", "volumeid_s": "v", "efnotext_b": True}, {"id": "v.page-000001", "volumeid_s": "v"},
    ]


CONCEPT = "documentId string, collectionName string, pageId string, concepts array<struct<text: string>>"


def test_concept_commands(spark):
    made = spark.createDataFrame(
        [("d", "c:", "000002.txt", [("a",), (None,), ("a",)]), ("d", "d", "000003.txt", []), ("d", "d", "x.txt", [("z",)])], CONCEPT
    )
    got = C.update_json(C.page_updates(made)).orderBy("ord").collect()
    assert [(r["target_id"], r["mode"]) for r in got] == [
        ("c:/d.page-000002", "remove"), ("c:/d.page-000002", "add"), ("c:/d", "remove"), ("c:/d", "add"),
    ]
    assert json.loads(got[1]["json"]) == {
        "id": "c:/d.page-000002", "volumeconcept_txt": {"add": ["a", "a"]}, "volumeconcept_htrcstrings": {"add": ["a", "a"]},
    }
    assert json.loads(got[2]["json"]) == {"id": "c:/d", "concept_t": {"remove": ["a", "a"]}, "concept_ss": {"remove": ["a", "a"]}}
    assert rows(C.bad_page_names(made), "source_page") == [("x.txt",)]
    assert rows(C.pages_without_concepts(made), "source_page") == [("000003.txt",)]


def test_concept_volume_commands(spark):
    ddl = "volId string, pages array<struct<concepts: array<struct<text: string>>>>"
    made = spark.createDataFrame([("v", [([("a",)],), ([("b",), (None,)],), (None,)]), ("e", []), ("n", None)], ddl)
    assert rows(C.volume_updates(made), "volume_id", "mode", "values") == [
        ("e", "add", []), ("e", "remove", []), ("v", "add", ["a", "b"]), ("v", "remove", ["a", "b"]),
    ]


def test_applying_updates(spark):
    store = spark.createDataFrame([("v", "f", "a", 3), ("v", "f", "b", 1)], "id string, field string, value string, n bigint")
    asked = spark.createDataFrame(
        [("v", "f", "a", 2, 1), ("v", "f", "a", 1, 2), ("v", "f", "c", 2, 1)], "id string, field string, value string, n bigint, at int"
    )
    once = C.apply_updates(store, asked, "at")
    want = [("a", 1), ("b", 1), ("c", 2)]
    assert rows(once, "value", "n") == want
    assert rows(C.apply_updates(once, asked, "at"), "value", "n") == want


def test_bloom_has_no_false_negatives(spark, tmp_path):
    words = spark.range(500).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    rest = spark.range(500, 3000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("term"))
    bloom = B.bloom_load_or_build(spark, str(tmp_path / "bloom"), words)
    again = B.bloom_load_or_build(spark, str(tmp_path / "bloom"), words)
    assert rows(bloom, "word_index", "bits") == rows(again, "word_index", "bits")
    inside = B.bloom_probe(words.withColumnRenamed("word", "term"), again)
    assert inside.count() == 500 and inside.filter("not might_contain").count() == 0
    assert B.bloom_probe(rest, again).filter("might_contain").count() < 2500 * 0.03


def test_dictionary_membership_and_expansion(spark):
    words = spark.createDataFrame([("a",), ("b",)], "word string")
    made = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "term string, i int")
    for small in (True, False):
        assert rows(B.in_dictionary(made, words, small=small), "term", "i") == [("a", 1), ("a", 2)]
    bigger = B.expand_dictionary(words)
    assert bigger.count() == 52 and bigger.filter("word = 'zb'").count() == 1


def test_one_answer_whatever_the_size(spark):
    """Repeated map entries and repeated page ids give the same by a constant map and by join, with a dictionary and without."""
    entries = [("en", "NN", "NOUN"), ("en", "NN", "PROPN"), ("de", "VB", "VERB")]
    repeated = spark.createDataFrame(entries, "lang string, tag string, upos string")
    page = "volume_id string, page_id string, langs array<string>, tokens array<struct<token: string, pos_tags: array<string>>>"
    made = spark.createDataFrame(
        [
            ("v", "p", ["en"], [("House", ["NN", "VB"]), ("sea", [])]),
            ("w", "p", ["de", "en"], [("Tree", ["VB"])]),
            ("x", "q", ["fr"], []),
            ("y", "r", [], [("odd", ["NN"])]),
        ],
        page,
    )
    words = spark.createDataFrame([("house",), ("tree",)], "word string")
    for dictionary in (None, words):
        arrays = W.term_arrays(made, dictionary)
        assert arrays.count() == 4
        got = [
            sorted((r.volume_id, r.page_id, sorted((f.field, tuple(f["values"])) for f in r.text_fields)) for r in D.text_fields(arrays, repeated, most).collect())
            for most in (100, 0)
        ]
        assert got[0] == got[1]
        assert ("en_PROPN_htrctokentext", ("house",)) in got[0][0][2]
    rows_ = spark.createDataFrame([("en", "NN")], "lang string, tag string")
    assert [r.upos for r in P.pos_lookup(rows_, repeated).collect()] == ["PROPN"]
    texts = {r.volume_id: (r.text, r.dictionary_text) for r in W.page_texts(made.withColumn("page_id", F.concat("volume_id", "page_id")), words).withColumn("volume_id", F.substring("page_id", 1, 1)).collect()}
    assert texts == {"v": ("house sea", "house"), "w": ("tree", "tree"), "x": ("", None), "y": ("odd", None)}


def test_large_side_with_nested_maps(spark):
    made = spark.sql("SELECT id AS k, named_struct('m', map('a', id)) AS s FROM range(5)")
    side = spark.sql("SELECT id AS k, array(id) AS v FROM range(3)")
    got = {r.k: r.v for r in lookup.left_lookup(made, side, ["k"], False).collect()}
    assert got == {0: [0], 1: [1], 2: [2], 3: None, 4: None}
    wide = spark.sql("SELECT array_repeat('x', 1000) AS v FROM range(3)")
    assert not lookup.fits_broadcast(wide, max_bytes=2000)


def test_a_dictionary_of_bounded_size_is_a_constant(spark):
    """Looked up inside the array and by join the same terms stay, and the first way shuffles nothing."""
    page = "page_id string, tokens array<struct<token: string, pos_tags: array<string>>>"
    made = spark.createDataFrame(
        [
            ("p", [("House-boat", ["NN"]), ("SEA", ["VB", "NNP"]), ("sea", []), ("Tree", ["JJ"])]),
            ("p", [("don't", ["NN"]), ("--", ["QQ"])]), ("q", []), (None, [("Tree-House sea", ["NN"])]), ("r", [("none", ["X"])]),
        ],
        page,
    )
    words = spark.createDataFrame([("house",), ("Tree-House sea",), ("sea",), ("Tree",), ("don't",), (None,)], "word string")
    for of in (words, words.limit(0)):
        for tokenize in (True, False):
            small, large = (W.term_arrays(made, of, tokenize, most) for most in (100, -1))
            one, other = (sorted(((r.page_id, [(t.term, t.pos_tags) for t in r.terms]) for r in f.collect()), key=str) for f in (small, large))
            assert one == other
            assert "Exchange" not in small._jdf.queryExecution().executedPlan().toString()


def test_ranges_are_those_of_a_plain_aggregate(spark):
    from quirelens.operators import explode as X

    made = spark.range(30_000).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("p"), (F.col("id") % 11).cast("string"))).alias("page_id"),
        F.concat(F.lit("é漢𝒳z"), (F.col("id") * 7919 % 1000).cast("string")).alias("token"), (F.col("id") % 3).cast("int").alias("n_tags"),
    )
    want = made.groupBy("page_id").agg(F.count("token").alias("n_tokens"), F.sum("n_tags").alias("n_tags"), F.min("token").alias("first_token"), F.max("token").alias("last_token"))
    got = X.token_ranges(made, "page_id")
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert X.token_ranges(made.limit(0), "page_id").collect() == []
    plan = X.token_ranges(made, "page_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.rindex("SortAggregate"), "what is sorted is a row for each batch and key"


def test_names_are_made_for_each_tag_of_a_page(spark):
    """A page of many terms: the field names come out of its different tags, not out of every term."""
    made = spark.createDataFrame(
        [("p", ["de", "en"], [(f"t{k}", ["NN", "JJ"] if k % 2 else ["ZZ"]) for k in range(1000)]), ("q", ["fr"], [("a", ["NN"])]), ("r", [], [("b", ["NN"])])],
        "page_id string, langs array<string>, terms array<struct<term: string, pos_tags: array<string>>>",
    )
    tags = spark.createDataFrame([("en", "JJ", "ADJ"), ("de", "NN", "NOUN")], "lang string, tag string, upos string")
    fields = D.text_fields(made, tags)
    got = {(r.page_id, f.field): len(f["values"]) for r in fields.collect() for f in r.text_fields}
    names = {n: f"{n}_htrctokentext" for n in ("de_NOUN", "en_ADJ", "de_X", "de", "en", "fr", "alllangs")}
    assert got == {
        ("p", names["de_NOUN"]): 500, ("p", names["en_ADJ"]): 500, ("p", names["de_X"]): 500, ("p", names["de"]): 1000, ("p", names["en"]): 500,
        ("p", names["alllangs"]): 1500, ("q", names["fr"]): 1, ("q", names["alllangs"]): 1,
    }
    assert fields.select(F.max(F.size("text_fields"))).first()[0] == 6
    made_in = fields._jdf.queryExecution().optimizedPlan().toString()
    assert made_in.count("lambdafunction(concat(") <= made_in.count("AS text_fields"), "no name is put together for each term"
