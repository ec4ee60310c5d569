"""Cutting unspaced scripts: against every way to cut, and by hand."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quirelens.functions import text
from quirelens.operators import segment


def brute(run, words):
    """Of all ways to cut, the best by the rule."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(run) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(run)]
        pieces = [run[a:b] for a, b in zip(edges, edges[1:])]
        if any(len(p) > 1 and p not in words for p in pieces):
            continue
        left = sum(p not in words for p in pieces)
        key = (left, len(pieces), [-len(p) for p in reversed(pieces)])
        if best is None or key < best[0]:
            best = (key, pieces)
    return best[1]


def cut(spark, runs, words):
    table = spark.createDataFrame([(w,) for w in words], "word string")
    made = segment.parts_that_are_words(spark.createDataFrame([(r,) for r in runs], "run string"), table)
    return {r.run: r.pieces for r in made.select("run", segment.best_path(F.col("run"), F.col("ends")).alias("pieces")).collect()}


@pytest.mark.parametrize("alphabet", ["漢字仮", "กขค"])
def test_best_path_is_that_of_brute_force(spark, alphabet):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(14)} - {alphabet[0]})
    runs = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 12))) for _ in range(150)})
    assert cut(spark, runs, words) == {r: brute(r, words) for r in runs}


def test_without_words_every_character_stands_alone(spark):
    assert cut(spark, ["日本語"], []) == {"日本語": ["日", "本", "語"]}
    long = "あ" * 400
    assert cut(spark, [long], ["あ" * 7]) == {long: ["あ"] * (400 % 7) + ["あ" * 7] * (400 // 7)}


def test_scripts_are_cut_apart_and_others_stay(spark):
    made = spark.createDataFrame([(1, "日本語テストabc123ไทยดี", ["NN"]), (2, "plain", ["VB"]), (2, "plain", ["VB"]), (3, None, []), (4, "Don't", ["X"])], "id int, term string, pos_tags array<string>")
    words = spark.createDataFrame([("日本",), ("日本語",), ("テスト",), ("ดี",), ("plain",)], "word string")
    got = sorted((r.id, r.term, r.pos_tags) for r in segment.segment_terms(made, words).filter("term is not null").collect())
    assert got == sorted([
        (1, "日本語", ["NN"]), (1, "テスト", ["NN"]), (1, "abc123", ["NN"]), (1, "ไ", ["NN"]), (1, "ท", ["NN"]), (1, "ย", ["NN"]), (1, "ดี", ["NN"]),
        (2, "plain", ["VB"]), (2, "plain", ["VB"]), (4, "Don't", ["X"]),
    ])
    assert segment.segment_terms(made, words).filter("id = 3").count() == 1


def test_word_break_results_stay_where_nothing_is_unspaced(spark):
    made = spark.createDataFrame([("well-known l’eau 3.14",)], "t string").select(F.explode(text.words(F.col("t"))).alias("term"))
    words = spark.createDataFrame([("well",)], "word string")
    assert sorted(r.term for r in segment.segment_terms(made, words).collect()) == sorted(r.term for r in made.collect())


def test_no_side_as_large_as_the_text_is_broadcast(spark):
    made = spark.createDataFrame([("日本語テスト",), ("ไทยดี",)], "term string").distinct()
    words = spark.createDataFrame([("日本",), ("ดี",)], "word string")
    plan = segment.segment_terms(made, words)._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in plan
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" in line]


@pytest.mark.parametrize("alphabet", ["漢字仮", "กขค"])
def test_held_words_and_joined_words_cut_alike(spark, alphabet):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(14)} - {alphabet[0]})
    runs = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 12))) for _ in range(150)})
    tree = segment.word_tree(words)
    assert {r: segment.cut_run(r, tree) for r in runs} == {r: brute(r, words) for r in runs}
    made = spark.createDataFrame([(f"x{r}7",) for r in [*runs, *runs[:9]]] + [("plain",), (None,)], "term string")
    table = spark.createDataFrame([(w,) for w in [*words, *words, "plain"]] + [(None,)], "word string")
    held, joined = (sorted(r.term or "" for r in segment.segment_terms(made, table, held_rows=n).collect()) for n in (segment.HELD_MAX_ROWS, 0))
    assert held == joined == sorted(["plain", ""] + [p for r in [*runs, *runs[:9]] for p in ["x", *brute(r, words), "7"]])


def test_a_long_run_takes_no_more_than_its_length(spark):
    """Ten thousand characters were forty thousand rows, each with the whole run, and a path that was copied at every step."""
    n = 10_007
    made = spark.createDataFrame([("日" * n,), ("ก" * 5,)], "term string")
    words = spark.createDataFrame([("日" * k,) for k in range(1, 5)], "word string")
    cut = segment.segment_terms(made, words)
    assert cut.groupBy(F.length("term").alias("n")).count().orderBy("n").collect() == [(1, 5), (3, 1), (4, n // 4)]
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "Generate explode(sequence" not in plan


def test_places_of_a_run_do_not_carry_it(spark):
    runs = spark.createDataFrame([("日本語",)], "run string")
    words = spark.createDataFrame([("日本",), ("日本語日本語",)], "word string")
    made = segment.parts_that_are_words(runs, words)
    joins = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "stop" in line]
    assert joins and not any(" run#" in line or "[run#" in line for line in joins)
    assert [(r.run, dict(r.ends)) for r in made.collect()] == [("日本語", {2: [2]})]
