"""The stored table: rounds of updates, what they read and write, and what is left of a broken one."""

import os

import pytest
from pyspark.sql import functions as F

from quirelens.operators.store import KeyedStore

DDL = "id string, value string, n int"


def rows(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.fixture()
def store(spark, tmp_path):
    made = spark.createDataFrame([(f"k{i}", f"v{i}", i) for i in range(500)], DDL)
    kept = KeyedStore.create(made, str(tmp_path / "store"), ["id"], parts=16, buckets=4)
    yield kept
    kept.close()


def test_rounds_equal_one_step(spark, store):
    want = {f"k{i}": (f"v{i}", i) for i in range(500)}
    for k, ids in enumerate((["k1", "k2", "k600"], ["k2", "k3"], ["k600", "k601"])):
        for i in ids:
            want[i] = (f"r{k}", None)
        store.update(spark.createDataFrame([(i, f"r{k}", None) for i in ids], DDL))
    assert rows(store.rows().select("id", "value")) == sorted((i, v) for i, (v, _) in want.items())
    assert {r.id: r.n for r in store.rows().collect()} == {i: n for i, (_, n) in want.items()}


def test_unknown_keys_stay_out_of_a_replace(spark, store):
    store.update(spark.createDataFrame([("k7", "new", 1), ("k9999", "new", 1)], DDL), add=False)
    assert store.rows().filter("id = 'k9999'").count() == 0
    assert store.rows().filter("value = 'new'").count() == 1 and store.rows().count() == 500


def test_only_touched_parts_are_read_and_written(spark, store):
    before = dict(store.manifest.versions)
    incoming = spark.createDataFrame([("k5", "x", 0)], DDL)
    part = incoming.select(store._part()).first()[0]
    plan = store.joined(incoming, True)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line)
    assert f"({part})" in scan or f"= {part}" in scan or str(part) in scan
    store.update(incoming)
    changed = {k for k, v in store.manifest.versions.items() if before.get(k) != v}
    assert changed == {part}
    new = [d for d, _, names in os.walk(f"{store.path}/rows") if f"_version={store.manifest.version}" in d and names]
    assert len(new) == 1


def test_the_stored_side_is_not_shuffled(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incoming = spark.createDataFrame([(f"k{i}", "x", 0) for i in range(50)], DDL)
        for add in (True, False):
            plan = store.joined(incoming, add)._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan
            assert "Bucketed: true" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_broken_round_changes_nothing(spark, store):
    before = rows(store.rows().select("id", "value"))
    broken = spark.createDataFrame([("k1", "x", 0), ("k2", "x", 1)], DDL)
    broken = broken.withColumn("value", F.when(F.col("n") == 1, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        store.update(broken)
    assert rows(store.rows().select("id", "value")) == before
    again = KeyedStore.open(spark, store.path)
    assert rows(again.rows().select("id", "value")) == before
    again.update(spark.createDataFrame([("k1", "y", 0)], DDL))
    assert again.rows().filter("value = 'y'").count() == 1
    again.close()


def test_opened_again_and_cleaned(spark, store):
    for k in range(3):
        store.update(spark.createDataFrame([("k1", f"r{k}", 0)], DDL))
    again = KeyedStore.open(spark, store.path)
    assert again.manifest == store.manifest and rows(again.rows().select("id", "value")) == rows(store.rows().select("id", "value"))
    assert len(again.vacuum()) == 3
    assert again.rows().count() == 500 and again.rows().filter("id = 'k1'").first().value == "r2"
    with pytest.raises(Exception):  # another writer has taken the version
        store.update(spark.createDataFrame([("k1", "a", 0)], DDL))
        again.update(spark.createDataFrame([("k1", "b", 0)], DDL))
    again.close()


def test_empty_store_and_empty_round(spark, tmp_path):
    none = spark.createDataFrame([], DDL)
    store = KeyedStore.create(none, str(tmp_path / "s"), ["id"], parts=4, buckets=2)
    assert store.rows().count() == 0
    store.update(none).update(spark.createDataFrame([("a", "b", 1)], DDL), add=False)
    assert store.rows().count() == 0
    store.update(spark.createDataFrame([("a", "b", 1)], DDL))
    assert rows(store.rows()) == [("a", "b", 1)]
    store.close()
