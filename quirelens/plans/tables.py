"""Volumes, pages, side tables and concept records derived from the given tables.

One row of ``documents`` is one volume record and each line of its text is a page, so a record is built
in a projection: no grouping, no numbering window, and a large source spreads over all tasks.
The record's shape (null pages, missing bodies, languages) follows from the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.functions import ids, text
from quirelens.operators import fields as M
from quirelens.operators.explode import unfold
from quirelens.settings import ORGANIZATION_TYPE, V15_STRINGS

RECORD_PREFIX = "https://data.example.org/extracted-features/20240115/"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores when the scan has fewer parts than that, as with one small file; else as they are."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def record_id(doc_id: Column, source: Column) -> Column:
    return F.when(doc_id % 2 == 0, F.concat(F.lit("qlib.ark:/77001/t"), doc_id.cast("string"))).otherwise(
        F.concat_ws(".", source, doc_id.cast("string"))
    )


def _documents(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    rows = spread(read(spark, sf_dir, table))
    if table == "benchmark":
        rows = rows.select(
            F.col("item_id").alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit("bench").alias("source"),
            F.length("text").cast("bigint").alias("n_chars"),
        )
    return rows.withColumn("volume_id", record_id(F.col("doc_id"), F.col("source")))


TAGS = ["NN", "VB", "JJ", "QQ"]


def _tag_counts(key: Column) -> Column:
    """A token's tags by its length, ``NNP`` beside it for a capital, none for a single character: constant maps, taken by place."""

    def tags(*extra: str) -> list[Column]:
        return [F.create_map(*[F.lit(v) for t in (tag, *extra) for v in (t, len(t))]) for tag in TAGS]

    none = F.create_map().cast("map<string, int>")
    capital = F.when(F.rlike(key, F.lit(r"^\p{Lu}")), len(TAGS)).otherwise(0)
    place = F.when(F.length(key) == 1, 2 * len(TAGS)).otherwise(F.length(key) % len(TAGS) + capital)
    return F.get(F.array(*tags(), *tags("NNP"), none), place)


def _counts(keys: Column, value) -> Column:
    return F.map_from_arrays(keys, F.transform(keys, value))


def _zone(tokens: Column, begin: Column, end: Column) -> Column:
    return F.struct(tokens.alias("tokenPosCount"), begin.alias("beginCharCounts"), end.alias("endCharCount"))


def _page(keys: Column, index: Column, lang: Column, version: str, zones: bool, bodies: bool) -> Column:
    n, width = F.size(keys), F.length(F.array_join(keys, ""))
    tag_counts = _counts(keys, _tag_counts)
    tokens = F.when(~((n == 2) & (width <= 8)), tag_counts)
    begin = end = F.lit(None).cast("map<string, int>")
    if zones:
        begin = _counts(F.array_distinct(F.transform(keys, lambda k: F.substr(k, F.lit(1), F.lit(1)))), lambda _: F.lit(1))
        end = _counts(F.array_distinct(F.transform(keys, lambda k: F.right(k, F.lit(1)))), lambda _: F.lit(1))
    body = F.when(n > 1, _zone(tokens, begin, end))
    no_lang = (n == 2) | (n == 3)
    if version == "2":
        label = F.when(~no_lang, lang).alias("calculatedLanguage")
    else:
        share = lambda code, p: F.create_map(code, F.lit(p))
        both = F.when(lang == "en", F.array(share(lang, "1.0"))).otherwise(
            F.array(share(lang, "0.71"), share(F.lit("en"), "0.29"))
        )
        label = F.when(no_lang, F.array().cast("array<map<string, string>>")).otherwise(both).alias("languages")
    parts = [F.format_string("%08d", index + 1).alias("seq"), label]
    if zones:
        number = F.concat(F.lit("p."), index.cast("string"))
        one = F.create_map(number, F.create_map(F.lit("C$D"), F.lit(1)))
        header = _zone(one, F.create_map(F.lit("p"), F.lit(1)), F.create_map(F.right(number, F.lit(1)), F.lit(1)))
        parts.append(header.alias("header"))
    if bodies:
        parts.append(body.alias("body"))
    if zones:
        none = F.lit(None)
        parts.append(
            F.when(F.lit(False), _zone(none.cast("map<string, map<string, int>>"), none.cast("map<string, int>"), none.cast("map<string, int>"))).alias("footer")
        )
    return F.when(~((n == 1) & (width <= 7)), F.struct(*parts))


def volumes(
    spark: SparkSession,
    sf_dir: str,
    version: str = "2",
    zones: bool = False,
    metadata: bool = False,
    table: str = "documents",
    bodies: bool = True,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """(id, volume_id, metadata, page_count, pages); metadata is JSON text, header and counts only with ``zones``.

    A query that reads no tokens asks for pages without ``bodies``.
    """
    rows = _documents(spark, sf_dir, table)
    lines = F.split("text", "\n")
    last = F.right("text", F.lit(1))
    count = F.size(lines) + F.when(last == ".", 0).when(last == "!", 1).otherwise(-1)
    # one separator for all, so that lines are cut at a plain character and not by a pattern
    spaced = F.split(F.replace(F.replace("text", F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" ")), "\n")
    keys = F.transform(spaced, lambda s: F.array_distinct(F.array_remove(F.split(s, " "), "")))
    meta = F.lit(None).cast("string")
    if metadata:
        meta = metadata_v2() if version == "2" else metadata_v15()
    found = rows.select(
        F.concat(F.lit(RECORD_PREFIX), F.col("volume_id")).alias("id"),
        "volume_id",
        meta.alias("metadata"),
        count.alias("page_count"),
        keys.alias("keys"),
        "lang",
        *[k.alias(f"_keep{i}") for i, k in enumerate(keep)],
    )
    pages = F.transform("keys", lambda k, i: _page(k, i, F.col("lang"), version, zones, bodies))
    kept = [F.col(f"_keep{i}") for i in range(len(keep))]
    return found.select("id", "volume_id", "metadata", "page_count", pages.alias("pages"), *kept)


def raw_volumes(
    spark: SparkSession, sf_dir: str, version: str = "2", zones: bool = False, table: str = "documents", keep: tuple[Column, ...] = ()
) -> DataFrame:
    """(key, json): the volumes as record text; a ``keep`` value of the source row stays as a further column."""
    found = volumes(spark, sf_dir, version, zones, True, table, keep=keep)
    features = F.struct(F.col("page_count").alias("pageCount"), F.col("pages").alias("pages"))
    body = F.to_json(F.struct("id", features.alias("features")), {"ignoreNullFields": "false"})
    record = F.concat(
        F.lit('{"metadata":'), F.coalesce("metadata", F.lit("null")), F.lit(","), F.substr(body, F.lit(2))
    )
    kept = [F.col(f"_keep{i}") for i in range(len(keep))]
    return found.select(F.col("volume_id").alias("key"), record.alias("json"), *kept)


def _damaged_page(page: Column, index: Column) -> Column:
    """A page's JSON text; of pages with tokens, seven kinds in eleven are damaged, by their number of tokens and place."""
    body = page["body"]
    tokens, n = F.to_json(body["tokenPosCount"]), F.size(body["tokenPosCount"])
    lang = F.coalesce(F.concat(F.lit('"'), page["calculatedLanguage"], F.lit('"')), F.lit("null"))

    def text(made: Column) -> Column:
        return _json('{"seq":"', page["seq"], '","calculatedLanguage":', lang, ',"body":', F.coalesce(made, F.lit("null")), "}")

    more = lambda entry: text(_json('{"tokenPosCount":{', entry, ",", F.substr(tokens, F.lit(2)), "}"))
    kind = F.when(n > 0, F.pmod(n + index, F.lit(11)))
    return (
        F.when(page.isNull(), F.lit("null"))
        .when(kind == 0, F.lit("7"))
        .when(kind == 1, F.lit('"damaged"'))
        .when(kind == 2, text(F.lit("[1]")))
        .when(kind == 3, text(F.lit('{"tokenPosCount":"none"}')))
        .when(kind == 4, more('"damaged token":3'))
        .when(kind == 5, more('"odd count":{"NN":"many"}'))
        .when(kind == 6, text(_json('{"tokenPosCount":', tokens, ',"beginCharCounts":{"x":1.5,"y":2}}')))
        .otherwise(text(F.to_json(body)))
    )


def damaged_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, json): record text with damaged pages, token counts and character counts."""
    found = volumes(spark, sf_dir)
    pages = F.array_join(F.transform("pages", _damaged_page), ",")
    record = _json('{"id":"', F.col("id"), '","features":{"pageCount":', F.col("page_count"), ',"pages":[', pages, "]}}")
    return found.select(F.col("volume_id").alias("key"), record.alias("json"))


def _json(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])


def _choice(selector: Column, *options: Column) -> Column:
    chosen = F.when(selector == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        chosen = chosen.when(selector == i, option)
    return chosen


def metadata_v2() -> Column:
    """Bibliographic metadata as JSON text; each member takes every form a record may have."""
    d, n, src, vol = F.col("doc_id"), F.col("n_chars"), F.col("source"), F.col("volume_id")
    year = F.lit(1800) + d % 200
    entity = '"type":"http://id.loc.gov/ontologies/bibframe/Person"'
    members = [
        _choice(d % 4, F.lit('"accessProfile":"google"'), F.lit('"accessProfile":"open"'), F.lit('"accessProfile":null'), F.lit("")),
        _choice(d % 2, F.lit('"accessRights":"pd"'), F.lit('"accessRights":"ic"')),
        _json('"id":"http://hdl.example.net/2027/', vol, '"'),
        _json('"title":"', src, " vol. ", d, '; a \\"new\\" edition"'),
        _json('"dateCreated":', F.lit(20200000) + d % 1000),
        _choice(d % 3, F.lit('"lastRightsUpdateDate":20180917'), F.lit('"lastRightsUpdateDate":"20180917"'), F.lit('"lastRightsUpdateDate":""')),
        _choice(d % 4, _json('"pubDate":', year), _json('"pubDate":"', year, '"'), F.lit('"pubDate":"18uu"'), _json('"pubDate":', year, ".7")),
        F.lit('"schemaVersion":"https://schemas.example.org/metadata_v_3.0"'),
        F.when(d % 5 != 0, F.lit('"typeOfResource":"http://id.loc.gov/ontologies/bibframe/Text"')).otherwise(""),
        _choice(d % 3, _json('"language":"', F.col("lang"), '"'), _json('"language":["', F.col("lang"), '","la"]'), F.lit('"language":7')),
        _choice(d % 4, _json('"oclc":"', n, '"'), _json('"oclc":["', n, '","', n + 1, '"]'), F.lit('"oclc":[]'), F.lit('"oclc":null')),
        _choice(
            d % 4,
            F.lit('"genre":"http://id.loc.gov/vocabulary/marcgt/fic"'),
            _json('"genre":["urn:uuid:', d, '","http://id.loc.gov/vocabulary/marcgt/ess"]'),
            _json('"genre":"urn:uuid:', d, '"'),
            F.lit('"genre":["http://id.loc.gov/vocabulary/marcgt/ess","http://id.loc.gov/vocabulary/marcgt/fic"]'),
        ),
        _choice(
            d % 5,
            _json('"contributor":{"id":"http://www.viaf.example/', d, '","name":"Author ', d, '",', entity, "}"),
            _json('"contributor":[{"id":"http://www.viaf.example/', d, '","name":"Author ', d, '",', entity, '},{"id":"urn:uuid:', d, '",', entity, "}]"),
            _json('"contributor":{"name":"Author ', d, '",', entity, "}"),
            _json('"contributor":[{"name":"Author ', d, '",', entity, '},{"id":"http://www.viaf.example/', n, '"}]'),
            F.lit(""),
        ),
        _json('"publisher":{"id":"http://lod.example.org/', src, '","name":"House of ', src, f'","type":"{ORGANIZATION_TYPE}"', "}"),
        _json('"pubPlace":{"id":"http://id.loc.gov/vocabulary/countries/', F.col("lang"), '",', F.when(d % 2 == 0, '"name":"Land",').otherwise(""), '"type":"http://id.loc.gov/ontologies/bibframe/Place"}'),
        _choice(d % 4, F.lit('"type":["DataFeedItem","Book"]'), F.lit('"type":["DataFeedItem","Serial"]'), F.lit('"type":["Other","Book"]'), F.lit('"type":["DataFeedItem"]')),
        _json('"sourceInstitution":{"name":"', F.upper(src), '","type":"', F.when(d % 6 == 0, "http://other.example.org/Type").otherwise(ORGANIZATION_TYPE), '"}'),
        _choice(
            d % 4,
            _json('"mainEntityOfPage":["https://catalog.example.org/Record/', d, '","http://catalog.example.org/brief","http://catalog.example.org/full"]'),
            _json('"mainEntityOfPage":["https://catalog.example.org/Record/', d, '"]'),
            _json('"mainEntityOfPage":["https://catalog.example.org/Record/', d, '","http://catalog.example.org/brief"]'),
            _json('"mainEntityOfPage":["http://catalog.example.org/other/', d, '"]'),
        ),
    ]
    whole = F.concat(F.lit("{"), F.array_join(F.filter(F.array(*members), lambda m: m != ""), ","), F.lit("}"))
    return F.when(d % 29 != 0, whole)


def metadata_v15() -> Column:
    d, n, src, vol = F.col("doc_id"), F.col("n_chars"), F.col("source"), F.col("volume_id")
    singles = []
    for name in V15_STRINGS:
        if name == "language":
            singles.append(_json('"language":"', F.when(F.col("lang") == "es", "").otherwise(F.col("lang")), '"'))
        else:
            singles.append(_json(f'"{name}":"{name} ', vol, '"'))
    members = [
        *singles,
        F.lit('"enumerationChronology":"no. 7","governmentDocument":false'),
        _choice(d % 2, _json('"oclc":["', n, '"]'), F.lit('"oclc":[]')),
        F.lit('"isbn":[],"issn":[]'),
        _json('"lccn":["ca ', d, '"]'),
        F.lit('"genre":["fiction","not fiction"]'),
        _json('"names":["Author ', d, '","', src, ' Collection "]'),
        _choice(d % 3, _json('"classification":{"lcc":["PR', d, '"]}'), _json('"classification":{"lcc":["PR', d, '"],"ddc":["8', d, '","9"]}'), F.lit('"classification":{}')),
    ]
    return F.concat(F.lit("{"), F.array_join(F.array(*members), ","), F.lit("}"))


def parsed_metadata(spark: SparkSession, sf_dir: str, version: str = "2") -> DataFrame:
    """(volume_id, metadata) with metadata as VARIANT; pages are not built."""
    made = metadata_v2() if version == "2" else metadata_v15()
    rows = _documents(spark, sf_dir, "documents").select("volume_id", made.alias("metadata"))
    return M.parse_metadata(rows)


def pos_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, tag, upos) for two of the languages the text comes in; the others have no map."""
    rows = [
        ("en", "NN", "NOUN"), ("en", "NNP", "NOUN"), ("en", "VB", "VERB"), ("en", "JJ", "ADJ"),
        ("de", "NN", "NOUN"), ("de", "VB", "VERB"),
    ]
    return spark.createDataFrame(rows, "lang string, tag string, upos string")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word): the distinct lowercased words of the benchmark passages."""
    return unfold(read(spark, sf_dir, "benchmark"), text.words(F.col("text"), True), "word").distinct()


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept page records: one per turn of a conversation, its long words as concepts."""
    rows = read(spark, sf_dir, "conversations")
    long_words = F.filter(text.words(F.col("text")), lambda w: F.length(w) > 8)
    found = F.transform(long_words, lambda w: F.struct(w.alias("text")))
    blank = F.array(F.struct(F.lit(None).cast("string").alias("text")))
    document = F.concat(F.lit("vol"), F.col("conv_id").cast("string"))
    number = F.when(F.length("text") < 40, F.concat(F.lit("p"), F.col("turn").cast("string"))).otherwise(
        F.format_string("%06d", F.col("turn"))
    )
    return rows.select(
        document.alias("documentId"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("qlib.ark:")).otherwise(document).alias("collectionName"),
        F.concat(document, F.lit("/"), number, F.lit(".txt")).alias("pageId"),
        F.when(F.col("role") == "user", F.concat(found, blank)).otherwise(found).alias("concepts"),
    )


def concept_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concept volume records: one per document, a page per line; no pages for a one-line document."""
    rows = _documents(spark, sf_dir, "documents")
    pages = F.transform(
        F.split("text", "\n"),
        lambda s: F.struct(
            F.transform(F.filter(text.words(s), lambda w: F.length(w) > 12), lambda w: F.struct(w.alias("text"))).alias("concepts")
        ),
    )
    return rows.select(F.col("volume_id").alias("volId"), F.when(F.size(pages) > 1, pages).alias("pages"))


def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id): volume ids with and without separators, from the web pages and the documents."""
    web = read(spark, sf_dir, "pages").select(F.col("url").alias("id"))
    named = _documents(spark, sf_dir, "documents").select(F.col("volume_id").alias("id"))
    coded = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("xyz."), (F.col("doc_id") + 50281736400917).cast("string"), F.lit(".v"), F.col("n_chars").cast("string")).alias("id")
    )
    bare = read(spark, sf_dir, "documents").select(F.col("source").alias("id")).distinct()
    return web.unionAll(named).unionAll(coded).unionAll(bare)


def stubby_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_list(spark, sf_dir).select(ids.id_to_stubby(F.col("id")).alias("path"))
