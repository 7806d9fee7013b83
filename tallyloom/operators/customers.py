"""Per-customer profiles."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import money, normalized_customer_id, share_pct


def compute_rfm(
    sales: DataFrame,
    reference_date: str | dt.date | dt.datetime | None = None,
    extra_features: Sequence[str] = (),
) -> DataFrame:
    """Recency, frequency and monetary value of each customer, plus items and the maximum of extra features.

    Recency counts calendar days up to ``reference_date``, by default the latest sale of all. That date
    is a scalar subquery over one column, not a value fetched to the driver.
    """
    if reference_date is None:
        reference = sales.groupBy().agg(F.max("InvoiceTS")).scalar()
    else:
        reference = F.lit(str(reference_date)).cast("timestamp")
    return (
        sales.groupBy("CustomerID")
        .agg(
            F.max("InvoiceTS").alias("LastPurchaseTS"),
            F.countDistinct("InvoiceNo").alias("Frequency"),
            F.sum("TotalAmount").alias("Monetary"),
            *[F.max(name).alias(name) for name in extra_features],
            F.sum("Quantity").alias("Sum_Qty"),
        )
        .withColumn("Recency", F.datediff(reference, F.col("LastPurchaseTS")))
    )


def top_customers(sales: DataFrame, n: int = 10) -> DataFrame:
    """The customers with the highest spend, ties by id. Ids are normalised first, so two spellings of one id are
    one customer, and lines whose id is blank or unreadable belong to none."""
    known = sales.withColumn("CustomerID", normalized_customer_id()).filter(F.col("CustomerID").isNotNull())
    spend = known.groupBy("CustomerID").agg(money(F.sum("TotalAmount")).alias("TotalAmount"))
    return spend.orderBy(F.desc("TotalAmount"), "CustomerID").limit(n)


def customer_country(sales: DataFrame) -> DataFrame:
    """Country of each customer's earliest line by (InvoiceTS, InvoiceNo, StockCode)."""
    first = F.min_by("Country", F.struct("InvoiceTS", "InvoiceNo", "StockCode"))
    return (
        sales.filter(F.col("CustomerID").isNotNull() & F.col("Country").isNotNull())
        .groupBy("CustomerID")
        .agg(first.alias("Country"))
    )


def kpi_customers(segments: DataFrame) -> DataFrame:
    """Customers, segments, mean monetary (2 decimals) and mean frequency (1 decimal)."""
    per_segment = segments.groupBy("Segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Monetary").alias("monetary"),
        F.count("Monetary").alias("with_monetary"),
        F.sum("Frequency").alias("frequency"),
        F.count("Frequency").alias("with_frequency"),
    )
    return per_segment.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_customers"),
        F.count("Segment").alias("total_segments"),
        money(F.try_divide(F.sum("monetary"), F.sum("with_monetary"))).alias("avg_monetary"),
        F.round(F.try_divide(F.sum("frequency"), F.sum("with_frequency")), 1).alias("avg_frequency"),
    )


def repeat_purchase(profiles: DataFrame) -> DataFrame:
    """Customers with several purchases against customers with exactly one."""
    counts = profiles.agg(
        F.count_if(F.col("Frequency") > 1).alias("repeat"),
        F.count_if(F.col("Frequency") == 1).alias("one_time"),
    ).withColumn("whole", F.col("repeat") + F.col("one_time"))
    return counts.unpivot(["whole"], ["repeat", "one_time"], "buyer_type", "Customers").select(
        "buyer_type", "Customers", share_pct(F.col("Customers"), F.col("whole")).alias("share_pct")
    )


def spend_per_visit(profiles: DataFrame) -> DataFrame:
    average = F.try_divide(F.col("Monetary"), F.col("Frequency"))
    return profiles.withColumn("AvgMonetaryPerInvoice", average)


def loyalty_effect(profiles: DataFrame) -> DataFrame:
    """Straight-line fit of spend per visit on purchase frequency, one row."""
    points = spend_per_visit(profiles).filter(
        F.col("AvgMonetaryPerInvoice").isNotNull() & F.col("Frequency").isNotNull()
    )
    y, x = F.col("AvgMonetaryPerInvoice"), F.col("Frequency").cast("double")
    return points.agg(
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.corr(y, x), 6).alias("corr"),
        F.count(F.lit(1)).alias("n"),
    )
