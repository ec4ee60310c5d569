"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table: a start and a step taken from its
name. The shards take turns and each claims its next free slot, so all get the same number of slots give or take
one, and a shard that comes or goes moves few of the others' slots. A row's key is hashed to a slot and the table
says the shard: one step for each row, with no shuffle, as the table is of fixed size and broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import query, table

SLOTS = 65537
MOST_SLOTS = 1 << 22
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))


def _number(name: str, seed: str) -> int:
    return int.from_bytes(hashlib.md5(f"{seed}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the position in ``shards`` of its owner. ``slots`` is a prime well above the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not len(shards) < slots <= MOST_SLOTS:
        raise ValueError(f"the table needs more slots than shards and at most {MOST_SLOTS}")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime, or a step could miss slots")
    place = [_number(s, "start") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            owner[place[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The key's slot; a null key is placed as the empty string is."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("bigint") % slots).cast("int")


def assign_shards(rows: DataFrame, key: str, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Adds ``shard_slot``, ``shard`` (replacing columns of these names). Every row keeps its place in the plan: no shuffle.

    Equal keys go to one shard; null keys go where the empty string goes. An empty table stays empty.
    """
    owners = rows.sparkSession.createDataFrame(
        [(i, shards[k]) for i, k in enumerate(lookup_table(shards, slots))], "shard_slot int, shard string"
    )
    return rows.drop("shard_slot", "shard").withColumn("shard_slot", slot(F.col(key), slots)).join(
        F.broadcast(owners), "shard_slot"  # SLOTS rows, at most MOST_SLOTS
    )


def shard_sizes(assigned: DataFrame) -> DataFrame:
    """Rows of each shard, for checking the balance."""
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"))


def _sql() -> str:
    """The owners as one character a slot, so the query stays short."""
    owners = "".join(chr(48 + k) for k in lookup_table(SHARDS)).replace("'", "''")
    return f"""
WITH slots AS (
  SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT % {SLOTS} AS INTEGER) AS shard_slot
  FROM documents
)
SELECT doc_id, shard_slot,
  'shard-' || lpad(CAST(ascii(substr('{owners}', shard_slot + 1, 1)) - 48 AS VARCHAR), 2, '0') AS shard
FROM slots
"""


@query("op2_maglev_shards", _sql())
def maglev_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return assign_shards(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "shard_slot", "shard")
