"""Down-sampling and partition sizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelens.operators.numbering import running_total
from quirelens.settings import FILES_PER_PARTITION, SAMPLE_SEED


def sample_frac(rows: DataFrame, fraction: float, seed: int = SAMPLE_SEED, partitions: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement, optionally spread over a given number of partitions."""
    taken = rows.sample(False, fraction, seed)
    return taken.repartition(partitions) if partitions else taken


def sample_keyed(rows: DataFrame, key: Column, fraction: float, seed: int = SAMPLE_SEED, partitions: int | None = None) -> DataFrame:
    """Rows whose key's seeded digest falls into the given fraction: the same rows under any partitioning."""
    digest = F.substr(F.md5(F.concat(F.lit(f"{seed}:"), key)), F.lit(1), F.lit(8))
    taken = rows.filter(F.conv(digest, 16, 10).cast("bigint") < int(fraction * 2**32))
    return taken.repartition(partitions) if partitions else taken


def every_n(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Rows 1, n+1, 2n+1, .. in the given order, with their 0-based position."""
    return running_total(rows, order, name="position").filter(F.col("position") % n == 0)


def partition_count(n: Column, per: int = FILES_PER_PARTITION, minimum: int | None = None) -> Column:
    """``floor(n / per) + 1``, not below ``minimum``."""
    found = F.floor(n / F.lit(per)) + 1
    return F.greatest(found, F.lit(minimum).cast("bigint")) if minimum else found


def size_partitions(rows: DataFrame, n_files: int, per: int = FILES_PER_PARTITION, minimum: int | None = None) -> DataFrame:
    """Rows spread over the number of partitions that the number of input files asks for."""
    return rows.repartition(max(n_files // per + 1, minimum or 1))
