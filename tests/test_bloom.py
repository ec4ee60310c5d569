"""Saved Bloom filters: when one is used, and when it is built again."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quirelens.operators import dictionary as B


def words(spark, n, prefix="w"):
    return spark.createDataFrame([(f"{prefix}{i}",) for i in range(n)], "word string")


def folders(path):
    return sorted(d for d in os.listdir(path) if d.startswith("bits-"))


def hits(spark, bloom, known):
    return B.bloom_probe(known.withColumnRenamed("word", "term"), bloom).filter("might_contain").count()


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "bloom")


def test_same_words_use_the_saved_filter(spark, path):
    first = B.bloom_load_or_build(spark, path, words(spark, 300))
    again = B.bloom_load_or_build(spark, path, words(spark, 300).unionAll(words(spark, 40)).repartition(5))  # order and repeats do not matter
    assert len(folders(path)) == 1
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_other_words_or_another_rate_do_not(spark, path):
    B.bloom_load_or_build(spark, path, words(spark, 300))
    other = B.bloom_load_or_build(spark, path, words(spark, 300, "x"))
    assert len(folders(path)) == 2 and hits(spark, other, words(spark, 300, "x")) == 300
    assert hits(spark, other, words(spark, 300)) < 20
    B.bloom_load_or_build(spark, path, words(spark, 300), 0.001)
    assert len(folders(path)) == 3
    B.bloom_load_or_build(spark, path, words(spark, 300))  # the first one is still there
    assert len(folders(path)) == 3


def test_what_no_manifest_names_is_not_used(spark, path):
    B.bloom_build(words(spark, 10)).write.parquet(f"{path}/bits-half")
    made = B.bloom_load_or_build(spark, path, words(spark, 300))
    assert hits(spark, made, words(spark, 300)) == 300 and len(folders(path)) == 2
    os.makedirs(f"{path}/manifests/unfinished")  # a manifest whose write was broken off
    B.bloom_load_or_build(spark, path, words(spark, 300))
    assert len(folders(path)) == 2


@pytest.mark.parametrize("harm", ["rows", "files", "folder"])
def test_a_filter_that_lost_rows_is_built_again(spark, path, harm, tmp_path):
    B.bloom_load_or_build(spark, path, words(spark, 300))
    folder = os.path.join(path, folders(path)[0])
    if harm == "folder":
        os.rename(folder, str(tmp_path / "gone"))
    elif harm == "files":
        for name in os.listdir(folder):
            os.rename(os.path.join(folder, name), str(tmp_path / name))
    else:
        kept = spark.read.parquet(folder).filter(F.col("word_index") != 3)
        kept.write.parquet(str(tmp_path / "less"))
        os.rename(folder, str(tmp_path / "whole"))
        os.rename(str(tmp_path / "less"), folder)
    made = B.bloom_load_or_build(spark, path, words(spark, 300))
    assert hits(spark, made, words(spark, 300)) == 300
    assert len(os.listdir(os.path.join(path, "manifests"))) == 2


def test_no_words(spark, path):
    none = words(spark, 1).filter("word is null")
    assert B.bloom_load_or_build(spark, path, none).count() == 0
    assert B.bloom_load_or_build(spark, path, none).count() == 0


def test_manifest_states_what_was_built(spark, path):
    B.bloom_load_or_build(spark, path, words(spark, 300))
    lines = spark.read.text(f"{path}/manifests", recursiveFileLookup=True).collect()
    manifest = json.loads(lines[0]["value"])
    assert manifest["n_words"] == 300 and manifest["version"] == 1 and manifest["shape"]["n_bits"] == B.bloom_shape(300)[0]
