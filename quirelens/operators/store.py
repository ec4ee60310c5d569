"""A stored table that is updated in place, a part at a time.

Rows are dealt to parts by a hash of their first key, and within a part to buckets by all keys. Every version of a part
is a partition of one bucketed table; a manifest names the version that counts for each part. A round of updates
reads and writes the parts its keys fall in, and no others; the stored side of its join is already dealt and sorted by
key, so only the updates are shuffled. A round counts once its manifest is written: before, nothing refers to its rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS, BUCKETS = 64, 16
PART, VERSION = "_part", "_version"


@dataclass
class Manifest:
    """Which version of each part counts; parts that hold nothing are missing."""

    version: int
    versions: dict[int, int]


class KeyedStore:
    """Rows with different, non-null keys below ``path``, at the version that counted when the store was opened or last updated."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: T.StructType, parts: int, buckets: int):
        self.spark, self.path, self.keys, self.schema, self.parts, self.buckets = spark, path.rstrip("/"), keys, schema, parts, buckets
        self.table = f"store_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        listed = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}, {PART} INT, {VERSION} INT) USING parquet OPTIONS (path '{self.path}/rows') "
            f"PARTITIONED BY ({PART}, {VERSION}) CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS"
        )
        self.manifest = Manifest(0, {})

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], parts: int = PARTS, buckets: int = BUCKETS) -> "KeyedStore":
        """A new store of the rows; fails where there is one."""
        spark = rows.sparkSession
        store = cls(spark, path, keys, rows.schema, parts, buckets)
        layout = {"keys": keys, "schema": rows.schema.json(), "parts": parts, "buckets": buckets}
        spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.text(f"{store.path}/layout")
        store._publish(rows, None)
        return store

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "KeyedStore":
        """The store at its last complete version."""
        path = path.rstrip("/")
        layout = json.loads(spark.read.text(f"{path}/layout").first()["value"])
        store = cls(spark, path, layout["keys"], T.StructType.fromJson(json.loads(layout["schema"])), layout["parts"], layout["buckets"])
        manifests = [json.loads(r["value"]) for r in spark.read.text(f"{path}/manifests", recursiveFileLookup=True).collect()]
        last = max(manifests, key=lambda m: m["version"])
        store.manifest = Manifest(last["version"], {int(k): v for k, v in last["versions"].items()})
        spark.sql(f"MSCK REPAIR TABLE {store.table}")
        return store

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.parts)).cast("int")

    def _current(self, parts: set[int] | None) -> DataFrame:
        """The rows that count, of some parts or of all; other parts and versions are not listed."""
        by_version: dict[int, list[int]] = {}
        for part, version in self.manifest.versions.items():
            if parts is None or part in parts:
                by_version.setdefault(version, []).append(part)
        chosen = F.lit(False)
        for version, of in sorted(by_version.items()):
            chosen = chosen | ((F.col(VERSION) == version) & F.col(PART).isin(of))
        return self.spark.table(self.table).filter(chosen)

    def rows(self) -> DataFrame:
        return self._current(None).select(*self.schema.names)

    def _publish(self, rows: DataFrame, touched: set[int] | None) -> None:
        version = self.manifest.version + 1
        dealt = rows.select(*self.schema.names, self._part().alias(PART), F.lit(version).alias(VERSION))
        # rows of one bucket in one task: one file for each part and bucket
        dealt = dealt.repartition(self.buckets, *self.keys)
        dealt.write.format("parquet").partitionBy(PART, VERSION).bucketBy(self.buckets, *self.keys).sortBy(*self.keys).mode("append").saveAsTable(self.table)
        written = {r[PART] for r in self.spark.table(self.table).filter(F.col(VERSION) == version).select(PART).distinct().collect()}
        kept = {k: v for k, v in self.manifest.versions.items() if touched is not None and k not in touched}
        versions = {**kept, **{k: version for k in written}}
        text = json.dumps({"version": version, "versions": {str(k): v for k, v in versions.items()}})
        # fails where another writer has taken this version
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{self.path}/manifests/{version:08d}")
        self.manifest = Manifest(version, versions)

    def joined(self, incoming: DataFrame, add: bool) -> DataFrame:
        """Stored rows of the parts that ``incoming`` touches, with its values where it names the key.

        ``incoming`` has the store's columns and each key once. Keys that are not stored come in only with ``add``.
        """
        return self._joined(incoming, add, self._touched(incoming))

    def _touched(self, incoming: DataFrame) -> set[int]:
        return {r["part"] for r in incoming.select(self._part().alias("part")).distinct().collect()}  # no more than there are parts

    def _joined(self, incoming: DataFrame, add: bool, touched: set[int]) -> DataFrame:
        values = [c for c in self.schema.names if c not in self.keys]
        new = incoming.select(*self.keys, F.struct(*values).alias("_new"))
        found = self._current(touched).join(new, self.keys, "full_outer" if add else "left")
        taken = [F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in values]
        return found.select(*self.keys, *taken).select(*self.schema.names)

    def update(self, incoming: DataFrame, add: bool = True) -> "KeyedStore":
        """One round: the next version has incoming values in place of stored ones of the same key."""
        touched = self._touched(incoming)
        if not add:
            touched &= set(self.manifest.versions)
        if touched:
            self._publish(self._joined(incoming, add, touched), touched)
        return self

    def vacuum(self) -> list[str]:
        """Delete the rows of versions that no longer count; returns the folders that went."""
        jvm = self.spark._jvm
        listed = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        gone = []
        for row in listed:
            part, version = (int(piece.split("=")[1]) for piece in row["partition"].split("/"))
            if self.manifest.versions.get(part) != version:
                folder = f"{self.path}/rows/{PART}={part}/{VERSION}={version}"
                at = jvm.org.apache.hadoop.fs.Path(folder)
                at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
                self.spark.sql(f"ALTER TABLE {self.table} DROP PARTITION ({PART}={part}, {VERSION}={version})")
                gone.append(folder)
        return gone

    def close(self) -> None:
        """Forget the table's name; the rows stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
