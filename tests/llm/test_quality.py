"""The robust estimate against its definition in numpy, and which estimate judges whom."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirelens.llm import quality
from quirelens.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, g long, shapes int, start string"


def document(rng, odd=False):
    if odd:
        return " ".join(rng.choice(["##$$%%", "||||", "<<>>&&"]) + "x" * rng.randrange(1, 30) for _ in range(60))
    return "\n".join(" ".join("w" * rng.randrange(2, 8) + str(rng.randrange(9000)) for _ in range(rng.randrange(8, 20))) for _ in range(rng.randrange(3, 8)))


def table(spark, sizes, odd=0, seed=1):
    """(lang, source) to number of documents; ``odd`` of each hundred are odd."""
    rng, rows = random.Random(seed), []
    for (lang, source), n in sizes.items():
        rows += [(len(rows) + k, document(rng, rng.randrange(100) < odd), lang, source, 1, 2, "s") for k in range(n)]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def grouped(docs):
    return quality.with_groups(quality.vectors(quality.statistics(docs)), Scratch(docs.sparkSession, "test"))


def fitting_rows(docs):
    rows = grouped(docs).filter(F.col("n_words") >= quality.MIN_WORDS).drop(*quality.GROUP)
    return rows.select("*", F.explode("shapes").alias("g_")).select(*[c for c in rows.columns if c != "shapes"], "g_.*")


def step(x, extra, centre, cov):
    """A concentration step in numpy: the moments of the nearest share, by whole bins of distance."""
    d2 = np.array([v @ np.linalg.solve(cov + np.diag(e), v) for v, e in zip(x - centre, extra)])
    bins = np.floor(16 * np.log2(1 + d2))
    edge = np.sort(bins)[int(np.ceil(quality.CORE_SHARE * len(x))) - 1]
    core = x[bins <= edge]
    return core.mean(axis=0), quality.CORE_FACTOR * np.cov(core.T, bias=True)


def log_det(cov):
    return np.linalg.slogdet(cov + np.diag([(f * quality.SCALE) ** 2 for f in quality.FLOOR]))[1]


def test_estimate_is_the_least_of_the_starts_and_stable(spark):
    docs = table(spark, {("en", "a"): 150, ("de", "b"): 90}, odd=15)
    fitting = fitting_rows(docs).cache()
    found = {r.g_lang: r for r in quality.least_determinant(fitting, Scratch(spark, "test")).collect()}
    assert set(found) == {"=en", "=de"}
    for group, r in found.items():
        rows = fitting.filter(F.col("g_lang") == group).collect()
        x = np.array([[q[f] for f in quality.FEATURES] for q in rows], dtype=float)
        extra = np.array([
            [(c + fl**2) * quality.SCALE**2 for c, fl in zip((0.5 / q.n_words, 0.25 / q.n_words, 0.25 / max(q.n_lines, 1), 0.25 / q.n_words), quality.FLOOR)] for q in rows
        ])
        centre = np.array([r[f"m{i}"] for i in range(4)])
        cov = np.array([[r[f"c{max(i, j)}{min(i, j)}"] for j in range(4)] for i in range(4)])
        assert log_det(step(x, extra, centre, cov)[1]) >= log_det(cov) - quality.STABLE * 1.01
        # no worse than the steps from medians alone, as far as they go
        med = np.median(x, axis=0)
        m, c = med, np.diag((1.4826 * np.median(abs(x - med), axis=0)) ** 2)
        for _ in range(quality.FIRST_STEPS):
            m, c = step(x, extra, m, c)
        assert log_det(cov) <= log_det(c) + 1e-6


def test_determinant(spark):
    rng = np.random.default_rng(3)
    for _ in range(5):
        a = rng.normal(size=(4, 4)) * 300
        cov = a @ a.T
        row = {f"c{i}{j}": float(cov[i, j]) for i, j in quality.PAIRS}
        got = quality.with_determinant(spark.createDataFrame([row])).first().log_det
        assert abs(got - log_det(cov)) < 1e-6


@pytest.mark.parametrize("odd", [0, 10, 20])
def test_odd_documents_go_and_others_stay(spark, odd):
    docs = table(spark, {("en", "a"): 300, ("en", "small"): 8, ("xx", "tiny"): 5, ("de", "b"): 100}, odd=odd, seed=odd)
    got = {r.doc_id: (r.kept, r.distance) for r in quality.judge_quality(docs).collect()}
    wrong = [r.doc_id for r in docs.collect() if got[r.doc_id][0] == ("##" in r.text or "||||" in r.text or "<<>>" in r.text)]
    assert wrong == []
    assert all(d is not None for _, d in got.values())  # every row is judged, those of small groups too


def test_small_groups_are_judged_by_language_and_then_by_all(spark):
    docs = table(spark, {("en", "a"): 80, ("en", "b"): 30, ("en", "c"): 40, ("fr", "a"): 20, ("fr", "b"): 25, ("de", "a"): 70})
    rows = grouped(docs)
    judges = {(r.lang, r.source): (r.g_lang, r.g_source) for r in rows.collect()}
    assert judges == {
        ("en", "a"): ("=en", "=a"), ("en", "b"): ("=en", "*"), ("en", "c"): ("=en", "*"), ("fr", "a"): ("*", "*"), ("fr", "b"): ("*", "*"), ("de", "a"): ("=de", "=a"),
    }
    counts = {(r.g_lang, r.g_source): r["count"] for r in fitting_rows(docs).groupBy("g_lang", "g_source").count().collect()}
    assert counts == {("=en", "=a"): 80, ("=en", "*"): 150, ("=de", "=a"): 70, ("*", "*"): 265}
