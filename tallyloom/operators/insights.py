"""Findings that combine sales lines with customer segments.

``insight_frame`` has one row per customer and is read by most findings below, some of them several
times: store it once and pass the stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.columns import money, money_mean, normalized_customer_id
from tallyloom.functions.quantiles import percentiles
from tallyloom.operators.customers import customer_country, spend_per_visit

# Texts of the churn-risk labels.
RISK_SAFE = "Aman / Belanja Kecil"
RISK_LAPSED_VIP = "⚠️ MANTAN VIP (Risiko Tinggi Hilang)"
RISK_ORDINARY_CHURN = "Churn Biasa"
RISK_ACTIVE_VIP = "VIP Aktif"


def _by_customer(sales: DataFrame) -> DataFrame:
    return sales.withColumn("CustomerID", normalized_customer_id()).filter(F.col("CustomerID").isNotNull())


def insight_frame(sales: DataFrame, segments: DataFrame) -> DataFrame:
    """Spend and invoices of each customer in ``sales`` next to the customer's stored segment profile."""
    spend = _by_customer(sales).groupBy("CustomerID").agg(
        F.sum("TotalAmount").alias("TotalAmount"), F.countDistinct("InvoiceNo").alias("Invoices")
    )
    profiles = segments.select(
        normalized_customer_id().alias("CustomerID"), "Recency", "Frequency", "Monetary", "Cluster", "Segment"
    )
    return spend.join(profiles, "CustomerID")


def pareto_segments(insight: DataFrame) -> DataFrame:
    """Revenue per segment, largest first, with the running share of all revenue.

    The running sum goes over one row per segment.
    """
    revenue = (
        insight.filter(F.col("Segment").isNotNull())
        .groupBy("Segment")
        .agg(F.sum("TotalAmount").alias("amount"))
    )
    largest_first = Window.orderBy(F.desc("amount"), "Segment").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("amount").over(largest_first)
    whole = F.sum("amount").over(Window.partitionBy())
    return revenue.select(
        "Segment",
        money(F.col("amount")).alias("TotalAmount"),
        F.round(F.try_divide(running, whole) * 100, 6).alias("CumulativePercentage"),
    ).orderBy(F.desc("TotalAmount"), "Segment")


def churn_risk(insight: DataFrame, recency_days: int = 90, top_share: float = 0.25, approx: bool = False) -> DataFrame:
    """Risk label per customer from days since the last purchase and the top-spender threshold."""
    top = percentiles(insight, ["Monetary"], [1 - top_share], approx=approx).drop("column_name")
    with_threshold = insight.withColumn("Threshold", top.scalar())
    lapsed, spender = F.col("Recency") > recency_days, F.col("Monetary") > F.col("Threshold")
    status = (
        F.when(lapsed & spender, RISK_LAPSED_VIP)
        .when(lapsed & ~spender, RISK_ORDINARY_CHURN)
        .when(~lapsed & spender, RISK_ACTIVE_VIP)
        .otherwise(RISK_SAFE)
    )
    return with_threshold.select("CustomerID", "Recency", "Monetary", "Threshold", status.alias("RiskStatus"))


def vip_segment(insight: DataFrame) -> DataFrame:
    """The segment with the highest mean Monetary, one row."""
    return (
        insight.filter(F.col("Segment").isNotNull())
        .groupBy("Segment")
        .agg(F.avg("Monetary").alias("mean"), money_mean("Monetary").alias("AvgMonetary"))
        .orderBy(F.desc("mean"), "Segment")
        .limit(1)
        .drop("mean")
    )


def vip_top_products(sales: DataFrame, insight: DataFrame, n: int = 5) -> DataFrame:
    """Products that earn most from customers of the VIP segment.

    Lines are summed per customer and product first, so the join sees each product of a customer once.
    """
    vip = vip_segment(insight).select("Segment").scalar()
    members = insight.filter(F.col("Segment") == vip).select("CustomerID")
    per_product = (
        _by_customer(sales)
        .filter(F.col("Description").isNotNull())
        .groupBy("CustomerID", "Description")
        .agg(F.sum("TotalAmount").alias("amount"))
    )
    return (
        per_product.join(members, "CustomerID", "left_semi")
        .groupBy("Description")
        .agg(money(F.sum("amount")).alias("TotalAmount"))
        .orderBy(F.desc("TotalAmount"), "Description")
        .limit(n)
    )


def loyalty_caps(insight: DataFrame, approx: bool = False) -> DataFrame:
    """Upper percentiles that bound the loyalty and risk views, one row."""
    columns = ["Frequency", "AvgMonetaryPerInvoice", "Monetary"]
    caps = percentiles(spend_per_visit(insight), columns, [0.98, 0.99], approx=approx)

    def cap(column: str, percentile: str) -> Column:
        return F.round(F.max(F.when(F.col("column_name") == column, F.col(percentile))), 6)

    return caps.agg(
        cap("Frequency", "p99").alias("freq_p99"),
        cap("AvgMonetaryPerInvoice", "p99").alias("avg_spend_p99"),
        cap("Monetary", "p98").alias("monetary_p98"),
    )


def vip_share_by_country(sales: DataFrame, insight: DataFrame, n: int = 10) -> DataFrame:
    """Customers and share of each segment in the ``n`` countries with most customers."""
    homes = customer_country(_by_customer(sales))
    cells = (
        insight.select("CustomerID", "Segment")
        .join(homes, "CustomerID")
        .groupBy("Country", "Segment")
        .agg(F.count(F.lit(1)).alias("Customers"))
    )
    sizes = cells.groupBy("Country").agg(F.sum("Customers").alias("size"))
    largest = sizes.orderBy(F.desc("size"), "Country").limit(n)
    labelled = cells.filter(F.col("Segment").isNotNull())
    row_total = F.sum("Customers").over(Window.partitionBy("Country"))
    return (
        labelled.join(F.broadcast(largest), "Country")
        .withColumn("SharePct", F.round(F.col("Customers") * F.lit(100.0) / row_total, 6))
        .orderBy(F.desc("size"), "Country", "Segment")
        .select("Country", "Segment", "Customers", "SharePct")
    )


def vip_share_by_country_wide(sales: DataFrame, insight: DataFrame, labels: list[str], n: int = 10) -> DataFrame:
    """The shares with one column per segment label; a segment absent from a country has share 0."""
    long = vip_share_by_country(sales, insight, n)
    return long.groupBy("Country").pivot("Segment", labels).agg(F.first("SharePct")).na.fill(0.0, labels)
