"""Queries: terms, dictionaries and word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelens.functions import text
from quirelens.operators import counts, dictionary, segment
from quirelens.operators import explode as X
from quirelens.operators import terms as W
from quirelens.plans import sql as Q
from quirelens.plans import tables as T
from quirelens.plans.registry import query
from quirelens.settings import shared_path


def token_pages(spark, d) -> DataFrame:
    return X.token_arrays(X.explode_pages(T.volumes(spark, d)))


def page_tokens(spark, d) -> DataFrame:
    return X.explode_tokens(X.explode_pages(T.volumes(spark, d)))


def _bags(pages: DataFrame, terms: str = "terms") -> DataFrame:
    """One row per page with terms: their number, the number of their tags, and all of them, sorted."""
    return pages.filter(F.size(terms) > 0).select(
        "page_id",
        F.size(terms).cast("bigint").alias("n_terms"),
        F.aggregate(f"{terms}.pos_tags", F.lit(0).cast("bigint"), lambda a, t: a + F.size(t)).alias("n_tags"),
        F.array_join(F.sort_array(f"{terms}.term"), " ").alias("terms"),
    )


BAG = " SELECT page_id, count(*) AS n_terms, sum(len(tags)) AS n_tags, string_agg({0}, ' ' ORDER BY {0}) AS terms FROM {1} GROUP BY page_id"


@query("tokenize_keep_case", Q.terms() + BAG.format("term", "trm"))
def tokenize_keep_case(spark, d):
    return _bags(token_pages(spark, d).withColumn("terms", text.split_terms(F.col("tokens"))))


@query("tokenize_lower", Q.terms() + BAG.format("lower(term)", "trm"))
def tokenize_lower(spark, d):
    return _bags(token_pages(spark, d).withColumn("terms", text.split_terms(F.col("tokens"), lower=True)))


@query("token_passthrough", Q.tokens() + BAG.format("token", "tokt"))
def token_passthrough(spark, d):
    return _bags(token_pages(spark, d).withColumn("terms", text.split_terms(F.col("tokens"), tokenize=False)))


@query("case_insensitive_terms", Q.terms() + BAG.format("lower(term)", "trm"))
def case_insensitive_terms(spark, d):
    raw = text.split_terms(F.col("tokens"), tokenize=False)
    return _bags(token_pages(spark, d).withColumn("terms", text.fold_terms(raw)))


FILTERED = """, sub AS (SELECT page_id, plang, tags, term, unnest(regexp_extract_all(term, '{tok}')) AS part FROM {src}),
kept AS (SELECT page_id, plang, tags, lower(part) AS term FROM sub
  WHERE term IN (SELECT word FROM dict) OR lower(part) IN (SELECT word FROM dict))"""
KEPT_TERMS = Q.DICT + FILTERED.format(tok=Q.TOK, src="trm")
RAW = ", raw AS (SELECT page_id, plang, tags, token AS term FROM tokt)"
KEPT_RAW = Q.DICT + RAW + FILTERED.format(tok=Q.TOK, src="raw")


def _gathered(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("page_id").agg(F.collect_list(F.struct("term", "pos_tags")).alias("terms"))
    return _bags(found)


@query("dictionary_filter", Q.terms() + KEPT_TERMS + BAG.format("term", "kept"))
def dictionary_filter(spark, d):
    return _gathered(W.dictionary_filter(W.terms(page_tokens(spark, d)), T.dictionary(spark, d), broken=True))


@query("dictionary_filter_raw", Q.tokens() + KEPT_RAW + BAG.format("term", "kept"))
def dictionary_filter_raw(spark, d):
    return _gathered(W.dictionary_filter(W.terms(page_tokens(spark, d), tokenize=False), T.dictionary(spark, d)))


@query("page_text_terms", Q.terms() + KEPT_TERMS + BAG.format("term", "kept"))
def page_text_terms(spark, d):
    return _bags(W.term_arrays(token_pages(spark, d), T.dictionary(spark, d)))


@query(
    "page_text_string",
    Q.terms() + Q.DICT + """, full_text AS (SELECT page_id, string_agg(lower(term), ' ' ORDER BY lower(term)) AS text FROM trm GROUP BY page_id),
 known AS (SELECT page_id, string_agg(lower(term), ' ' ORDER BY lower(term)) AS dictionary_text FROM trm WHERE lower(term) IN (SELECT word FROM dict) GROUP BY page_id)
 SELECT page_id, coalesce(text, '') AS text, dictionary_text FROM ix LEFT JOIN full_text USING (page_id) LEFT JOIN known USING (page_id)""",
)
def page_text_string(spark, d):
    return W.page_texts(token_pages(spark, d), T.dictionary(spark, d))


@query("word_frequency", Q.terms() + " SELECT lower(term) AS term, count(*) AS n FROM trm GROUP BY lower(term)")
def word_frequency(spark, d):
    return counts.word_frequency(page_tokens(spark, d))


@query("pos_frequency", Q.tokens() + " SELECT tag, count(*) AS n FROM tagged GROUP BY tag")
def pos_frequency(spark, d):
    return counts.pos_frequency(page_tokens(spark, d))


@query("dictionary_semi_join", Q.terms() + Q.DICT + " SELECT term, count(*) AS n FROM trm WHERE term IN (SELECT word FROM dict) GROUP BY term")
def dictionary_semi_join(spark, d):
    rows = W.terms(page_tokens(spark, d))
    return dictionary.in_dictionary(rows, T.dictionary(spark, d)).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


# Phrases of the benchmark and of conversations, written without spaces in other letters: each a Han and kana run, a
# number and a Thai run. The words of the benchmark, in the same letters, are the table.
LATIN = "abcdefghijklmnopqrstuvwxyz"
HAN = "日月火水木金土山川田人口目手足耳あいうえおカキクケコ"
THAI = "กขคงจชซญดตถทธนบปผพฟมยรลวสห"


@query(
    "segment_unspaced",
    f"""WITH RECURSIVE phrase AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z ]+')) AS p FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations)),
 joined AS (SELECT DISTINCT replace(p, ' ', '') AS s FROM phrase WHERE trim(p) <> ''),
 word AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark),
 dict AS MATERIALIZED (SELECT translate(w, '{LATIN}', '{HAN}') AS word FROM word UNION SELECT translate(w, '{LATIN}', '{THAI}') FROM word),
 term AS MATERIALIZED (SELECT translate(s, '{LATIN}', '{HAN}') AS a, CAST(length(s) AS VARCHAR) AS b, translate(s, '{LATIN}', '{THAI}') AS c FROM joined),
 run AS MATERIALIZED (SELECT DISTINCT unnest([a, c]) AS run FROM term),
 place AS (SELECT run, unnest(range(1, length(run) + 1)) AS stop FROM run),
 part AS (SELECT run, stop, unnest(range(1, least(stop, (SELECT max(length(word)) FROM dict)) + 1)) AS len FROM place),
 ends AS MATERIALIZED (SELECT run, stop, list(len) AS lens FROM part WHERE substr(run, stop - len + 1, len) IN (SELECT word FROM dict) GROUP BY run, stop),
 path AS (SELECT run, CAST(0 AS BIGINT) AS reached, [CAST(0 AS BIGINT)] AS costs, [CAST(0 AS BIGINT)] AS back FROM run
  UNION ALL SELECT run, reached + 1, list_append(costs, best.cost), list_append(back, -best.back) FROM (
   SELECT p.run, p.reached, costs, back, list_sort(list_append(list_transform(coalesce(lens, []), lambda l: {{'cost': costs[p.reached + 2 - l] + 1, 'back': -l}}),
    {{'cost': costs[p.reached + 1] + 1000001, 'back': CAST(-1 AS BIGINT)}}))[1] AS best
   FROM path p LEFT JOIN ends e ON e.run = p.run AND e.stop = p.reached + 1 WHERE p.reached < length(p.run))),
 walk AS (SELECT run, reached, back, []::VARCHAR[] AS pieces FROM path WHERE reached = length(run)
  UNION ALL SELECT run, reached - back[reached + 1], back, list_prepend(substr(run, reached - back[reached + 1] + 1, back[reached + 1]), pieces) FROM walk WHERE reached > 0),
 cut AS (SELECT run, pieces FROM walk WHERE reached = 0),
 piece AS (SELECT unnest(x.pieces) AS term FROM term JOIN cut x ON x.run = a UNION ALL SELECT b FROM term UNION ALL SELECT unnest(y.pieces) FROM term JOIN cut y ON y.run = c)
 SELECT term, count(*) AS n FROM piece GROUP BY term""",
)
def segment_unspaced(spark, d):
    texts = T.read(spark, d, "benchmark").select("text").unionAll(T.read(spark, d, "conversations").select("text"))
    phrases = X.unfold(texts, F.regexp_extract_all(F.lower("text"), F.lit("[a-z ]+"), F.lit(0)), "p").filter(F.trim("p") != "")
    joined = phrases.select(F.replace("p", F.lit(" "), F.lit("")).alias("s")).distinct()
    in_han, in_thai = (lambda c: F.translate(c, LATIN, HAN)), (lambda c: F.translate(c, LATIN, THAI))
    terms = joined.select(F.concat(in_han("s"), F.length("s").cast("string"), in_thai("s")).alias("term"))
    words = X.unfold(T.read(spark, d, "benchmark"), F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)), "w").distinct()
    known = words.select(F.explode(F.array(in_han("w"), in_thai("w"))).alias("word"))
    return segment.segment_terms(terms, known).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


BLOOM = """, shape AS (SELECT CAST(greatest(32, ceil(-count(*) * ln(0.01) / (ln(2) * ln(2)))) AS BIGINT) AS m FROM dict),
pos AS (SELECT word, CAST('0x' || substr(md5(k || ':' || word), 1, 8) AS BIGINT) % m AS p FROM dict, shape, (SELECT unnest(range(1, 8)) AS k)),
bloom AS (SELECT p // 32 AS word_index, bit_or(CAST(1 AS BIGINT) << (p % 32)) AS bits FROM pos GROUP BY ALL)"""
BLOOM_ROWS = "WITH " + Q.DICT[1:] + BLOOM + " SELECT word_index, bits, m AS n_bits, 7 AS n_hashes FROM bloom, shape"


@query("bloom_build", BLOOM_ROWS)
def bloom_build(spark, d):
    return dictionary.bloom_build(T.dictionary(spark, d))


# The bits as one list, each word's places tested against it: no row for each place and no join.
PLACES = ["CAST('0x' || substr(md5('{k}:' || {w}), 1, 8) AS BIGINT) % m".replace("{k}", str(k)) for k in range(1, 8)]


@query(
    "bloom_probe",
    Q.terms() + Q.DICT + f""", words AS MATERIALIZED (SELECT word FROM dict),
 shape AS MATERIALIZED (SELECT CAST(greatest(32, ceil(-count(*) * ln(0.01) / (ln(2) * ln(2)))) AS BIGINT) AS m FROM words),
 places AS MATERIALIZED (SELECT DISTINCT unnest([{', '.join(p.format(w='word') for p in PLACES)}]) AS p FROM words, shape),
 bits AS MATERIALIZED (SELECT list(p IS NOT NULL ORDER BY i) AS bits FROM (SELECT unnest(range(m)) AS i FROM shape) LEFT JOIN places ON p = i),
 cand AS MATERIALIZED (SELECT lower(term) AS term, count(*) AS n FROM trm GROUP BY lower(term))
 SELECT term, n, {' AND '.join(f"bits[{p.format(w='term')} + 1]" for p in PLACES)} AS might_contain FROM cand, shape, bits""",
)
def bloom_probe(spark, d):
    rows = W.terms(page_tokens(spark, d), lower=True).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return dictionary.bloom_probe(rows, dictionary.bloom_build(T.dictionary(spark, d)))


@query("bloom_reuse", BLOOM_ROWS)
def bloom_reuse(spark, d):
    path = shared_path(spark, "bloom")
    dictionary.bloom_load_or_build(spark, path, T.dictionary(spark, d))
    return dictionary.bloom_load_or_build(spark, path, T.dictionary(spark, d))


@query("dictionary_expand", "WITH " + Q.DICT[1:] + " SELECT chr(CAST(97 + i AS INT)) || word AS word FROM dict, (SELECT unnest(range(26)) AS i)")
def dictionary_expand(spark, d):
    return dictionary.expand_dictionary(T.dictionary(spark, d))
