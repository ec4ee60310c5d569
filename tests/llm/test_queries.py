"""The registered queries with SQL against it, and the pipeline over the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

import check  # noqa: E402
import corpus_pipeline  # noqa: E402
from quirelens.llm import decontamination, jaccard, pii, queries  # noqa: E402


@pytest.mark.parametrize("key", sorted(queries.CHECKS))
def test_query(spark, sf_dir, key):
    assert check.compare(spark, check.connect(sf_dir), key, sf_dir).startswith("ok")


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir).cache()
        seen[name] = out
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out
    one = seen["ngram_jaccard_join"]
    links = jaccard.link_documents(one)
    assert links.filter("doc_id != component_id").count() == 0
    clean = seen["benchmark_decontamination"]
    assert decontamination.contamination(clean, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated").count() == 0
    assert pii.report(seen["pii"]).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
    packed = seen["best_fit_packing"]
    assert packed.select("doc_id").distinct().count() == seen["pii"].count()


def test_pipeline_takes_awkward_rows(spark, sf_dir):
    """Null and empty texts, null and repeated ids, equal rows, columns of clashing names, a table without rows."""
    ddl = "doc_id long, text string, lang string, source string, n_chars long, _id int, spans string, score double, row long, label string"
    word = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    made = [(k, word(k % 9)) for k in range(40)] + [(50, None), (51, ""), (52, " \n"), (None, word(70)), (None, word(71)), (3, word(72)), (4, word(4)), (4, word(4))]
    made += [(60, "write to someone@example.org or +44 20 7946 0018 " + word(80)), (61, "x" * 100_000)]
    rows = [(i, t, "en", "s", len(t or ""), 1, "s", 0.5, 2, "l") for i, t in made]
    docs = spark.createDataFrame(rows, ddl).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == docs.columns, name
        docs = out
    kept = docs.collect()
    assert sum(r.text is None for r in kept) == 1 and all(r._id == 1 and r.label == "l" for r in kept)
    assert len({r.text for r in kept if r.text and r.text.startswith("w")}) == len([r for r in kept if r.text and r.text.startswith("w")])
    assert not any("someone@example.org" in (r.text or "") for r in kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == len({r.doc_id for r in kept})
    none = spark.createDataFrame([], ddl)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0, name
