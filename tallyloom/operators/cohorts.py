"""Monthly cohorts of customers by first purchase within the given sales.

The cohort results first shrink the lines to one row per customer (and month), so no task ever holds all
lines of one customer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.columns import money_mean, months_since, year_month
from tallyloom.functions.joins import skew_join
from tallyloom.functions.staging import stage


def _known(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("CustomerID").isNotNull() & F.col("InvoiceTS").isNotNull())


def cohort_assign(sales: DataFrame) -> DataFrame:
    """Every line with its CohortMonth (``yyyy-MM``) and CohortIndex (1 = the first month).

    The first purchases are stored at once, so the lines are read twice in all.
    """
    lines = _known(sales)
    first = stage(
        lines.groupBy("CustomerID").agg(
            F.min("InvoiceTS").alias("__first"), F.count(F.lit(1)).alias("__lines")
        ),
        "first-purchases",
    )
    return (
        skew_join(lines, first, "CustomerID", row_count="__lines")
        .withColumns(
            {"CohortMonth": year_month("__first"), "CohortIndex": months_since("InvoiceTS", "__first")}
        )
        .select(*sales.columns, "CohortMonth", "CohortIndex")
    )


def cohort_counts(sales: DataFrame) -> DataFrame:
    """Distinct customers per (CohortMonth, CohortIndex)."""
    months = _known(sales).select("CustomerID", F.trunc("InvoiceTS", "MM").alias("month")).distinct()
    # at most one row per calendar month in each customer's window
    first = F.min("month").over(Window.partitionBy("CustomerID"))
    return (
        months.withColumn("cohort", first)
        .groupBy(
            year_month("cohort").alias("CohortMonth"),
            months_since("month", "cohort").alias("CohortIndex"),
        )
        .agg(F.count(F.lit(1)).alias("Customers"))
    )


def cohort_retention(sales: DataFrame) -> DataFrame:
    """Cohort cells with the cohort's size in its first month and the retained share."""
    size = F.max(F.when(F.col("CohortIndex") == 1, F.col("Customers"))).over(
        Window.partitionBy("CohortMonth")
    )
    return (
        cohort_counts(sales)
        .withColumn("CohortSize", size)
        .withColumn("Retention", F.round(F.try_divide("Customers", "CohortSize"), 6))
        .orderBy("CohortMonth", "CohortIndex")
    )


def cohort_retention_wide(sales: DataFrame, indexes: Sequence[int] | None = None) -> DataFrame:
    """Retention with one column ``m<index>`` per cohort index.

    Without ``indexes`` there is a column for each index that occurs. The long form is stored first, so the sales
    are read once and the driver sees the distinct indexes of that small table only.
    """
    retention = stage(cohort_retention(sales), "retention")
    if indexes is None:
        indexes = sorted(r["CohortIndex"] for r in retention.select("CohortIndex").distinct().collect())
    cells = [F.max(F.when(F.col("CohortIndex") == i, F.col("Retention"))).alias(f"m{i}") for i in indexes]
    if not cells:
        return retention.select("CohortMonth").distinct()
    return retention.groupBy("CohortMonth").agg(*cells)


def cohort_ltv(sales: DataFrame) -> DataFrame:
    """Mean accumulated spend per customer of each cohort."""
    per_customer = _known(sales).groupBy("CustomerID").agg(
        F.min("InvoiceTS").alias("first"), F.sum("TotalAmount").alias("spend")
    )
    return (
        per_customer.groupBy(year_month("first").alias("CohortMonth"))
        .agg(money_mean("spend").alias("AvgLTV"))
        .orderBy("CohortMonth")
    )
