"""Positions and running totals in a total order, without one task that holds all rows."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirelens.settings import shared_path


def running_total(rows: DataFrame, order: list[str], weight: Column | None = None, name: str = "before") -> DataFrame:
    """Rows with the sum of ``weight`` over all rows before them in the given order; with no weight, their 0-based position.

    Rows are dealt by ranges and written with their range's number, so that numbers stay if a task runs again. The
    sum of each range is one row; what lies before a range is a constant of the plan, as long as there are ranges.
    Inside a range a window adds up. Which of equal rows comes first is open.
    """
    spark = rows.sparkSession
    weighed = rows.withColumn("_weight", F.lit(1).cast("bigint") if weight is None else weight.cast("bigint"))
    ranged = weighed.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    path = shared_path(spark, "ranges")
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    sums = {r["_range"]: r["total"] or 0 for r in ranged.groupBy("_range").agg(F.sum("_weight").alias("total")).collect()}
    totals = [sums.get(k, 0) for k in range(max(sums, default=0) + 1)]
    starts = F.lit([0, *accumulate(totals)][:-1]).cast("array<bigint>")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.get(starts, F.col("_range")) + F.coalesce(F.sum("_weight").over(inside), F.lit(0))
    return ranged.withColumn(name, before).drop("_range", "_weight")
