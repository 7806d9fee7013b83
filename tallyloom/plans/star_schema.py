"""Raw transaction lines and companions derived from a star schema (region ... lineitem).

Irregular rows (missing and padded values, cancellations, unreadable dates) follow from key arithmetic,
so that any SQL engine derives the same table. The joins carry no hints: small dimension tables are
broadcast by Spark's own size check, skewed shuffle partitions are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


HOME = "NATION_0"
DEFAULTS = [f"NATION_{i}" for i in range(5)]
UNMAPPED_REGION = "MIDDLE EAST"

# Country names given to nation keys 0..24 by real_countries().
REAL_COUNTRIES = [
    "United Kingdom", "Germany", "France", "EIRE", "Netherlands", "Japan", "Singapore", "Hong Kong",
    "Israel", "Korea, Republic of", "USA", "Canada", "Costa Rica", "Brazil", "Argentina", "RSA", "Kenya",
    "Egypt", "Australia", "Unspecified", "European Community", "Bahrain", "Malta", "Czech Republic",
    "Atlantis",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str, country: Column | None = None) -> DataFrame:
    """Raw lines in the columns of ``schema.RAW``; ``country`` replaces the nation name expression."""
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    order, returned = F.col("o_orderkey"), F.col("l_returnflag") == "R"
    order_time = F.timestamp_add("HOUR", (order % 16 + 6).cast("int"), F.col("o_orderdate"))
    customer = F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))
    product = F.concat("p_name", F.lit(" "), "p_type", F.lit(" "), "p_brand")
    return lines.select(
        F.concat(F.when(returned, "C").otherwise(""), order.cast("string")).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.when(F.col("p_partkey") % 53 != 0, product).alias("Description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int").alias("Quantity"),
        F.when(order % 97 == 0, "not-a-date")
        .otherwise(F.date_format(order_time, "yyyy-MM-dd HH:mm:ss"))
        .alias("InvoiceDate"),
        F.when(F.col("p_partkey") % 101 == 0, 0.0).otherwise(F.col("p_retailprice")).alias("UnitPrice"),
        F.when(order % 50 == 7, None).when(order % 50 == 8, "  ").otherwise(customer).alias("CustomerID"),
        F.concat(
            F.when(order % 11 == 0, "  ").otherwise(""),
            F.lower("n_name") if country is None else country,
        ).alias("Country"),
    )


#: The segment names of the customer table.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def real_countries() -> Column:
    """Country expression with real names, for the built-in region mapping."""
    return F.element_at(F.array(*[F.lit(c) for c in REAL_COUNTRIES]), F.col("n_nationkey") + 1)


def region_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Country, Region) from the nation and region tables, one region left unmapped."""
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") != UNMAPPED_REGION)
        .select(F.upper("n_name").alias("Country"), F.col("r_name").alias("Region"))
    )


def fixed_segments(spark: SparkSession, sf_dir: str, rfm: DataFrame) -> DataFrame:
    """Segment frame with a fixed labelling: each profile takes the market segment of its customer."""
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("CustomerID"),
        F.col("c_mktsegment").alias("Segment"),
    )
    names = customers.select("Segment").distinct()
    position = F.row_number().over(Window.orderBy("Segment")) - 1  # one row per segment name
    numbered = names.withColumn("Cluster", position)
    return rfm.join(customers, "CustomerID").join(numbered, "Segment").select(
        "CustomerID", "Recency", "Frequency", "Monetary", "Cluster", "Segment"
    )
