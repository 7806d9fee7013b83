"""Running totals in a global order, without a task that holds all rows of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.staging import stage


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], value: str, out: str, label: str = "ranges"
) -> DataFrame:
    """``df`` plus ``out``, the sum of ``value`` up to and including the row in ``order`` within its group.

    Rows are dealt out by ranges of (group, order) and stored, so that the ranges stay what they are; a row's total
    is the running sum inside its range plus the sums of its group's ranges before. Groups are not null.
    """
    groups = [F.col(c) for c in by]
    ranged = stage(df.repartitionByRange(*groups, *order).withColumn("__range", F.spark_partition_id()), label)
    sums = ranged.groupBy(*by, "__range").agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*by, "__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__before"))
    upto = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumn("__inside", F.sum(value).over(upto))
    return inside.join(before, [*by, "__range"]).select(*df.columns, (F.col("__inside") + F.col("__before")).alias(out))
