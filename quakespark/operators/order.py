"""Numbering rows of a large table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quakespark.session import checkpointed


def number_rows(df: DataFrame, order: list, name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers in ``order``: ranged partitions, counted, then numbered side by side."""
    ranged = checkpointed(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part").orderBy(*order)
    return (
        ranged.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, "_part")
        .withColumn(name, (F.col("_before") + F.col("_rank") - 1 + start).cast("bigint"))
        .drop("_part", "_rank", "_before")
    )
