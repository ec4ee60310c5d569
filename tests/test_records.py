"""Hand-written records: sources, unfolding, identifiers, sinks."""

import bz2
import json

import pytest
from pyspark.sql import functions as F

from quirelens.functions import ids
from quirelens.operators import counts, docstore, sampling
from quirelens.operators import explode as X
from quirelens.sinks import files, named, updates
from quirelens.sources import listed, lists, records

ROOT = "https://data.example.org/extracted-features/20240115/"


def zone(tokens=None, begin=None, end=None):
    return {"tokenPosCount": tokens, "beginCharCounts": begin, "endCharCount": end}


def page(tokens=None, lang="en", seq="00000001"):
    body = None if tokens is None else zone(tokens)
    return {"seq": seq, "calculatedLanguage": lang, "header": None, "body": body, "footer": None}


def record(volume, pages, count=None, **more):
    features = {"pageCount": len(pages) if count is None else count, "pages": pages}
    return json.dumps({"id": ROOT + volume, "metadata": {"title": volume}, "features": features, **more})


def parsed(spark, texts, **options):
    raw = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "key string, json string")
    return records.parse_volumes(raw, **options)


def rows(frame, *names):
    return sorted(tuple(r[n] for n in names) for r in frame.select(*names).collect())


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def test_page_bounds_and_null_pages(spark):
    texts = [
        record("a.short", [page({"x": {"NN": 1}}), None], 3),
        record("a.long", [page({"x": {"NN": 1}}), page({"y": {"NN": 1}}), page({"z": {"NN": 1}})], 2),
        record("a.bare", [page(None), page({}), {"seq": "3", "body": zone(None)}]),
    ]
    good, bad = parsed(spark, texts)
    pages = X.explode_pages(good)
    assert rows(pages, "page_id") == [
        ("a.bare.page-000000",), ("a.bare.page-000001",), ("a.bare.page-000002",),
        ("a.long.page-000000",), ("a.long.page-000001",), ("a.short.page-000000",),
    ]
    assert rows(X.indexable_pages(pages), "page_id") == [
        ("a.bare.page-000001",), ("a.long.page-000000",), ("a.long.page-000001",), ("a.short.page-000000",),
    ]
    assert rows(X.audit_page_counts(good), "volume_id", "page_count", "n_pages") == [("a.long", 2, 3), ("a.short", 3, 2)]
    assert bad.count() == 0


def test_token_without_tags_is_kept(spark):
    good, _ = parsed(spark, [record("a.t", [page({"one": {}, "two": {"NN": 3, "VB": 1}})])])
    tokens = X.explode_tokens(X.explode_pages(good))
    assert rows(tokens, "token", "pos_tags") == [("one", []), ("two", ["NN", "VB"])]
    assert rows(X.explode_pos(tokens), "token", "tag") == [("two", "NN"), ("two", "VB")]


def test_bad_records_are_set_aside(spark):
    texts = [record("a.b", [page({"x": {"NN": 1}})]), "{not json", '{"id": "x"}', '{"features": {"pageCount": 1}}']
    good, bad = parsed(spark, texts)
    assert rows(good, "volume_id") == [("a.b",)]
    assert rows(bad, "key", "reason") == [("k1", "unparsable"), ("k2", "no features"), ("k3", "no id")]
    heads, again = parsed(spark, texts, pages=False)
    assert "pages" not in heads.columns and rows(heads, "volume_id", "page_count") == [("a.b", 1)]
    assert rows(again, "key", "reason") == rows(bad, "key", "reason")
    strict, _ = parsed(spark, texts, strict=True)
    with pytest.raises(Exception, match="bad record"):
        strict.collect()


def test_version_15_languages(spark):
    pages = [{"languages": [{"ko": "0.71"}, {"ja": "0.29"}], "body": zone({"x": {"NN": 1}})}, {"languages": [], "body": None}]
    good, _ = parsed(spark, [json.dumps({"id": "a.v", "features": {"pageCount": 2, "pages": pages}})], version="1.5")
    assert rows(X.explode_pages(good), "page_index", "langs") == [(0, ["ko", "ja"]), (1, [])]
    assert rows(good, "volume_id") == [("a.v",)]


def test_totals_with_missing_parts(spark):
    good, bad = parsed(spark, [record("a.b", [page(None)] * 3), '{"id": "q", "features": {"pageCount": 0, "pages": []}}', '{"id": "r", "features": {}}'])
    assert counts.page_total(good).first()["n_pages"] == 3
    assert rows(counts.pages_per_volume(good), "volume_id", "n_pages") == [("a.b", 3), ("q", 0)]
    assert rows(bad, "key", "reason") == [("k2", "no page count")]


@pytest.mark.parametrize(
    "given, friendly, stubby",
    [
        ("qlib.ark:/77001/v58kd93x", "qlib.ark+=77001=v58kd93x", "qlib/a+715dx/qlib.ark+=77001=v58kd93x.json.bz2"),
        ("xyz.50281736400917", "xyz.50281736400917", "xyz/58301/xyz.50281736400917.json.bz2"),
        ("a.b.c.d", "a.b,c,d", "a/b,/a.b,c,d.json.bz2"),
        ("plain", "plain", "plain/pi/plain.plain.json.bz2"),
    ],
)
def test_ids(spark, given, friendly, stubby):
    assert one(spark, ids.os_friendly(F.lit(given))) == friendly
    assert one(spark, ids.id_to_stubby(F.lit(given))) == stubby


def test_id_round_trips(spark):
    assert one(spark, ids.pairtree_to_id(F.lit("qlib/pairtree_root/x/qlib.ark+=77001=t4.json.bz2"))) == "qlib.ark:/77001/t4"
    assert one(spark, ids.volume_id(F.lit(ROOT + "xyz.1"))) == "xyz.1"
    assert one(spark, ids.volume_id(F.lit("xyz.1"))) == "xyz.1"
    assert one(spark, ids.concept_page_id(F.lit("x/12000031.txt"))) == "page-000031"
    assert one(spark, ids.concept_page_id(F.lit("x/31.txt"))) is None
    assert one(spark, ids.output_name(F.lit("/a/b/list.v1.txt"), "pos")) == "pos-list-out"


def test_packed_round_trip(spark, tmp_path):
    made = spark.createDataFrame([("k1", '{"a": "é"}'), ("k2", "{}")], "key string, json string")
    files.write_packed(made, str(tmp_path / "packed"))
    assert rows(records.read_packed(spark, str(tmp_path / "packed")), "key", "json") == [("k1", '{"a": "é"}'), ("k2", "{}")]


def test_file_list(spark, tmp_path):
    root = tmp_path / "files"
    plus = "qlib/a+3/files/qlib.ark+=77001=t4,1.json.bz2"
    for name in ("a/one.json.bz2", "a/b/two words.json.bz2", "c/three.json.bz2", plus):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(bz2.compress(json.dumps({"name": name}, indent=1).encode()))
    wanted = tmp_path / "list.txt"
    wanted.write_text(f"a/one.json.bz2\na/b/two words.json.bz2\n{plus}\n")
    got = listed.read_listed(spark, str(wanted), str(root))
    assert [(p, json.loads(j)["name"]) for p, j in rows(got, "path", "json")] == [
        ("a/b/two words.json.bz2",) * 2, ("a/one.json.bz2",) * 2, (plus, plus),
    ]
    wanted.write_text("a/one.json.bz2\nmissing.json.bz2\n")
    assert listed.read_listed(spark, str(wanted), str(root), strict=False).count() == 1
    with pytest.raises(Exception, match="listed file not found"):
        listed.read_listed(spark, str(wanted), str(root)).collect()


def test_pos_map_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "en-a.map").write_text("NN\tVERB\nOLD\tX\n")
    (tmp_path / "sub" / "en-b.map").write_text("# comment\n\n  \nNN\tNOUN\t\nVB\tVERB\nVB\tAUX\none\na\tb\tc\n")
    (tmp_path / "de.map").write_text("NN\tNOUN\r\n")
    (tmp_path / "fr.map~").write_text("NN\tNOUN\n")
    got = rows(lists.read_pos_maps(spark, str(tmp_path)), "lang", "tag", "upos")
    assert got == [("de", "NN", "NOUN"), ("en", "NN", "NOUN"), ("en", "VB", "AUX")]


def test_dictionary_words_stay_as_they_are(spark, tmp_path):
    (tmp_path / "words.txt").write_text("One\n two\nOne\n")
    assert rows(lists.read_dictionary(spark, str(tmp_path / "words.txt")), "word") == [(" two",), ("One",)]


def test_concept_files(spark, tmp_path):
    made = [{"documentId": "d", "collectionName": "c:", "pageId": f"{i:06d}.txt", "concepts": [{"text": "t"}]} for i in range(2)]
    (tmp_path / "array.json").write_text(json.dumps(made, indent=2))
    got = lists.read_concept_array(spark, str(tmp_path / "array.json"))
    lists.to_oneliners(got).write.text(str(tmp_path / "lines"))
    assert rows(lists.read_concepts(spark, str(tmp_path / "lines")), "pageId") == [("000000.txt",), ("000001.txt",)]


def test_count_lines_refuse_to_overwrite(spark, tmp_path):
    made = spark.createDataFrame([("a", 2), ("b", 1)], "term string, n bigint")
    out = str(tmp_path / "counts")
    files.write_counts(made, "term", out)
    assert rows(spark.read.text(out), "value") == [("(a,2)",), ("(b,1)",)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_counts(made, "term", out)


def test_endpoints(spark):
    made = [
        (1, "http://h:8983/search", "c", None), (2, "http://h:8983/search", "c", "n1:1,n2:2"),
        (3, "http://h/search", "c", "n1:1,n2:2"), (4, None, "c", "n1:1"),
    ]
    got = updates.expand_endpoints(spark.createDataFrame(made, "i int, base string, collection string, nodes string"))
    assert rows(got, "i", "url") == [
        (1, "http://h:8983/search/c/update"), (2, "http://n1:1/search/c/update"), (2, "http://n2:2/search/c/update"),
        (3, "http://h/search/c/update"), (3, "http://h/search/c/update"),
    ]


def test_delivery_and_candidates(spark, tmp_path):
    made = spark.createDataFrame([("v", f"d{i}", "{}") for i in range(20)], "volume_id string, doc_id string, json string")
    commands = updates.update_commands(made, ["u1", "u2"])
    assert {tuple(r["endpoints"]) for r in commands.collect()}.__len__() == 1
    assert all(len(r["endpoints"]) == 10 for r in commands.collect())
    assert updates.update_commands(made, []).first()["endpoints"] == []
    target = str(tmp_path)

    def writer(part):
        for r in part:
            with open(f"{target}/{r['doc_id']}", "w") as f:
                f.write(r["json"])

    updates.deliver(commands, writer)
    assert len(list(tmp_path.iterdir())) == 20


def test_docstore_keys_and_clashes(spark):
    tokens = {"a.b": {"N.N": 1}, "a<PERIOD>b": {"NN": 2}, "$x": {"C$D": 1}, "a.b$c": {"NN": 1}}
    good, _ = parsed(spark, [record("a.d", [page(tokens)])])
    body = docstore.safe_zone_maps(X.explode_pages(good)).select("body.tokenPosCount").first()[0]
    assert body == {
        "a<PERIOD>b": {"N<PERIOD>N": 1}, "<DOLLAR>x": {"C<DOLLAR>D": 1}, "a<PERIOD>b<DOLLAR>c": {"NN": 1},
    }


def test_safe_keys_of_whole_counts(spark):
    """Counts that are whole already are not cast, and maps without unsafe keys are not made again."""
    tokens = {"a.b": {"N.N": 1, "NN": 2}, "a<PERIOD>b": {"NN": 2}, "none": None, "empty": {}}
    plain = {"x": {"NN": 1}, "y": None}
    pages = [(1, (tokens, {".": 1, "<PERIOD>": 2}, {"$": None})), (2, (plain, {"x": 1}, None)), (3, (None, {}, {})), (4, None)]
    zone = "struct<tokenPosCount: map<string, map<string, int>>, beginCharCounts: map<string, int>, endCharCount: map<string, int>>"
    made = spark.createDataFrame([(n, z, None, z) for n, z in pages], f"n int, header {zone}, footer {zone}, body {zone}")
    safe = docstore.safe_zone_maps(made)
    safe_tokens = {"a<PERIOD>b": {"N<PERIOD>N": 1, "NN": 2}, "none": None, "empty": {}}
    want = {1: (safe_tokens, {"<PERIOD>": 1}, {"<DOLLAR>": None}), 2: (plain, {"x": 1}, None), 3: (None, {}, {}), 4: None}
    for r in safe.collect():
        assert r["body"] == r["header"] == want[r["n"]] and r["footer"] is None
    plan = safe.select("body")._jdf.queryExecution().analyzed().toString()
    assert "try_cast" not in plan and "try_cast" in docstore.safe_zone_maps(
        made.withColumns({z: F.col(z).cast(zone.replace("int", "string")) for z in ("header", "body", "footer")})
    )._jdf.queryExecution().analyzed().toString()


def test_replace_does_not_insert(spark):
    store = spark.createDataFrame([("a", "old"), ("b", "old")], "_id string, doc string")
    new = spark.createDataFrame([("a", "n1", 1), ("a", "n2", 2), ("c", "n", 1)], "_id string, doc string, at int")
    assert rows(docstore.replace_only(store, new, "at"), "_id", "doc") == [("a", "n2"), ("b", "old")]


def test_every_n_counts_across_partitions(spark):
    made = spark.range(1000).select(F.format_string("p%04d", (F.col("id") * 7) % 1000).alias("path")).repartition(7)
    assert rows(sampling.every_n(made, ["path"], 300), "position", "path") == [
        (0, "p0000"), (300, "p0300"), (600, "p0600"), (900, "p0900"),
    ]


def test_partition_count(spark):
    assert one(spark, sampling.partition_count(F.lit(2999))) == 1
    assert one(spark, sampling.partition_count(F.lit(3000))) == 2
    assert one(spark, sampling.partition_count(F.lit(3000), minimum=100)) == 100
    assert sampling.size_partitions(spark.range(10), 9000).rdd.getNumPartitions() == 4


def test_sampling_is_seeded(spark):
    made = spark.range(0, 10000, 1, 4)
    first = sampling.sample_frac(made, 0.01)
    assert rows(first, "id") == rows(sampling.sample_frac(made, 0.01), "id")
    assert 50 < first.count() < 160


def test_catalogue_languages(spark):
    texts = ['{"language":"eng"}', '{"language":["eng","fre"]}', '{"language":""}', '{"language":7}', "{bad", "{}"]
    made = spark.createDataFrame([(t,) for t in texts], "metadata string").select(F.try_parse_json("metadata").alias("metadata"))
    assert [tuple(r) for r in counts.catalog_lang_frequency(made).collect()] == [("eng", 2), ("fre", 1)]
    assert [tuple(r) for r in counts.catalog_lang_frequency(made, keep_null=True).collect()] == [(None, 4), ("eng", 2), ("fre", 1)]


def test_page_documents_in_folders(spark, tmp_path):
    good, _ = parsed(spark, [record("a.b", [page({"x": {"NN": 1}}), page(None)])])
    pages = X.explode_pages(good)
    made = X.indexable_pages(pages).select("volume_id", F.col("page_id").alias("doc_id"), F.lit('{"add":{}}').alias("json"))
    want = [("a/b/a.b/pages/page-000000.json.bz2", '{"add":{}}'), ("a/b/a.b/pages/page-000001.json.bz2", "{}")]
    out = str(tmp_path / "out")
    lists_ = named.write_named(files.page_files(pages, made), out)
    assert rows(listed.read_listed(spark, lists_, out), "path", "json") == want


def test_rehearsal_makes_every_document(spark):
    made = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("b", "3", "x")], "volume_id string, doc_id string, json string")
    got = {r.volume_id: (r.n_documents, r.digest) for r in files.rehearse(made, F.md5("json")).collect()}
    assert got["a"][0] == 2 and got["b"][0] == 1 and got["a"][1] != got["b"][1]
    broken = made.withColumn("json", F.when(F.col("doc_id") == "3", F.raise_error(F.lit("cannot be made"))).otherwise("x"))
    with pytest.raises(Exception, match="cannot be made"):
        files.rehearse(broken, F.md5("json")).collect()


def test_progress_by_group(spark):
    total = spark.createDataFrame([("k1", "a"), ("k2", "a"), ("k3", "b"), ("k3", "b"), (None, "c")], "key string, source string")
    done = spark.createDataFrame([("k1",), ("k1",), ("k9",)], "key string")
    got = rows(counts.progress(done, total, "key", "source"), "source", "n_done", "n_total", "percent")
    assert got == [("a", 1, 2, 50.0), ("b", 0, 1, 0.0), ("c", 0, 1, 0.0)]


def test_dry_run_counts(spark):
    assert files.dry_run(spark.range(17)) == {"n_rows": 17}


def test_odd_counts_and_page_counts_lose_nothing_silently(spark):
    def volume(count, page_count='"pageCount": 1,', page=None):
        page = page or '{"seq": "1", "body": {"tokenPosCount": {"word": {"NN": %s}, "other": {"VB": 1}}}}' % count
        return '{"id": "x.1", "metadata": {}, "features": {%s "pages": [%s]}}' % (page_count, page)

    cases = {
        "float": volume("1.5"), "text": volume('"x"'), "large": volume("99999999999"), "textual": volume("1", '"pageCount": "1",'),
        "uncounted": volume("1", ""), "odd page": volume("1", page='"none"'), "no pages": '{"id": "x.1", "metadata": {}, "features": {"pageCount": 1}}',
    }
    raw = spark.createDataFrame(list(cases.items()), "key string, json string")
    got = {r.key: r for r in records.judge_volumes(raw).collect()}
    for key in ("float", "text", "large", "textual"):
        assert got[key].reason is None and got[key].page_count == 1
        assert set(got[key].pages[0].body.tokenPosCount) == {"word", "other"}
    assert {k: got[k].reason for k in ("uncounted", "no pages")} == {"uncounted": "no page count", "no pages": "no pages"}
    assert got["odd page"].reason is None and got["odd page"].pages == [None]  # the page goes, not its volume
    for key in ("uncounted", "odd page", "no pages"):
        with pytest.raises(Exception, match="bad record"):
            records.judge_volumes(raw.filter(raw.key == key), strict=True).collect()
