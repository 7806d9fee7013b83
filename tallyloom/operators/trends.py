"""Sales over time, by country and by product, and their top lists.

Inputs are sales lines with InvoiceTS and TotalAmount. Each aggregate has at most one distinct column,
which Spark evaluates by first grouping on (key, invoice): a hot key never meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.columns import money, share_pct, weekday, year_month
from tallyloom.schema import HOME_COUNTRY, REPORT_DAYS

_INVOICES = "InvoiceNo"


def _revenue(alias: str = "Total_Sales") -> Column:
    return money(F.sum("TotalAmount")).alias(alias)


def _invoices(alias: str = "Transactions") -> Column:
    return F.countDistinct(_INVOICES).alias(alias)


def _sales_by_country_and(period: Column, name: str, sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(period.alias(name), "Country")
        .agg(_revenue("Revenue"), _invoices(), F.sum("Quantity").alias("ItemsSold"))
        .orderBy(name, "Country")
    )


def sales_daily(sales: DataFrame) -> DataFrame:
    return _sales_by_country_and(F.to_date("InvoiceTS"), "SaleDate", sales)


def sales_monthly(sales: DataFrame) -> DataFrame:
    return _sales_by_country_and(year_month(), "YearMonth", sales)


def _grouped(sales: DataFrame, key: Column, name: str) -> DataFrame:
    return sales.withColumn(name, key).filter(F.col(name).isNotNull()).groupBy(name)


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return _grouped(sales, year_month(), "Month").agg(_revenue()).orderBy("Month")


def country_revenue(sales: DataFrame) -> DataFrame:
    return _grouped(sales, F.col("Country"), "Country").agg(_revenue())


def dow_sales(sales: DataFrame) -> DataFrame:
    return _grouped(sales, weekday(), "Day").agg(_revenue(), _invoices())


def day_dimension(sales: DataFrame) -> DataFrame:
    """The fixed reporting weekdays with their display position."""
    days = [(day, i) for i, day in enumerate(REPORT_DAYS, start=1)]
    return sales.sparkSession.createDataFrame(days, "Day string, DayOrdinal int")


def dow_sales_ordered(sales: DataFrame) -> DataFrame:
    """Weekday sales on the fixed day list; a day without sales stays as an empty row."""
    return (
        day_dimension(sales)
        .join(dow_sales(sales), "Day", "left")
        .select("DayOrdinal", "Day", "Total_Sales", "Transactions")
        .orderBy("DayOrdinal")
    )


def _hour_label(hour: Column) -> Column:
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def hourly_sales(sales: DataFrame, peak_from: int = 10, peak_to: int = 15) -> DataFrame:
    """Sales per hour of day, labelled ``HH:00``, with the peak hours flagged."""
    by_hour = _grouped(sales, F.hour("InvoiceTS"), "h").agg(_revenue(), _invoices())
    return by_hour.select(
        _hour_label(F.col("h")).alias("Hour"),
        "Total_Sales",
        "Transactions",
        F.col("h").between(peak_from, peak_to).alias("is_peak"),
    ).orderBy("Hour")


def product_sales(sales: DataFrame) -> DataFrame:
    return _grouped(sales, F.col("Description"), "Product").agg(
        F.sum("Quantity").alias("Quantity"), _revenue()
    )


def top_products(sales: DataFrame, n: int = 10, name_length: int = 25) -> DataFrame:
    """Best sellers by quantity, with names cut to ``name_length`` for display."""
    name = F.col("Product")
    short = F.when(
        F.length(name) > name_length, F.concat(F.substring(name, 1, name_length), F.lit("..."))
    ).otherwise(name)
    best = product_sales(sales).orderBy(F.desc("Quantity"), "Product").limit(n)
    return best.select("Product", short.alias("ShortName"), "Quantity", "Total_Sales")


def home_vs_international(sales: DataFrame, home_country: str = HOME_COUNTRY) -> DataFrame:
    home = F.col("Country") == home_country
    totals = sales.agg(
        F.coalesce(F.sum(F.when(home, F.col("TotalAmount"))), F.lit(0.0)).alias("home"),
        F.coalesce(F.sum(F.when(~home, F.col("TotalAmount"))), F.lit(0.0)).alias("international"),
    ).withColumn("whole", F.col("home") + F.col("international"))
    return totals.unpivot(["whole"], ["home", "international"], "market", "amount").select(
        "market",
        money(F.col("amount")).alias("Total_Sales"),
        share_pct(F.col("amount"), F.col("whole")).alias("share_pct"),
    )


def top_international(sales: DataFrame, home_country: str = HOME_COUNTRY, n: int = 10) -> DataFrame:
    abroad = sales.filter(F.col("Country") != home_country)
    return country_revenue(abroad).orderBy(F.desc("Total_Sales"), "Country").limit(n)


def daily_transactions_ma(sales: DataFrame, rows: int = 7) -> DataFrame:
    """Distinct invoices per day and their mean over the last ``rows`` listed days.

    The mean is empty until ``rows`` days exist, and days without sales are not filled in. The window
    runs unpartitioned over one row per calendar day.
    """
    daily = _grouped(sales, F.to_date("InvoiceTS"), "Date").agg(_invoices())
    trailing = Window.orderBy("Date").rowsBetween(1 - rows, 0)
    full = F.count(F.lit(1)).over(trailing) == rows
    mean = F.round(F.avg("Transactions").over(trailing), 6)
    return daily.select("Date", "Transactions", F.when(full, mean).alias(f"MA{rows}")).orderBy("Date")


def kpi_sales(sales: DataFrame) -> DataFrame:
    """Revenue, items, and two invoice counts.

    ``weekday_transactions`` adds up the distinct invoices of each weekday, so an invoice that spans two
    weekdays counts twice; ``transactions`` counts it once.
    """
    per_invoice_day = sales.groupBy("InvoiceNo", weekday().alias("Day")).agg(
        F.sum("TotalAmount").alias("amount"), F.sum("Quantity").alias("items")
    )
    return per_invoice_day.agg(
        money(F.sum("amount")).alias("revenue"),
        F.count_if(F.col("InvoiceNo").isNotNull() & F.col("Day").isNotNull()).alias("weekday_transactions"),
        F.countDistinct("InvoiceNo").alias("transactions"),
        F.sum("items").cast("bigint").alias("items_sold"),
    )


def _basket(sales: DataFrame, key: Column, name: str) -> DataFrame:
    return _grouped(sales, key, name).agg(
        F.sum("TotalAmount").alias("amount"), _invoices("Invoices")
    ).select(
        name,
        money(F.col("amount")).alias("TotalAmount"),
        "Invoices",
        F.round(F.try_divide(F.col("amount"), F.col("Invoices")), 6).alias("AvgBasketSize"),
    )


def dow_basket(sales: DataFrame) -> DataFrame:
    """Mean invoice value per reporting weekday that has sales, in display order."""
    days = day_dimension(sales).withColumnRenamed("Day", "DayOfWeek")
    return (
        _basket(sales, weekday(), "DayOfWeek")
        .dropna()
        .join(F.broadcast(days), "DayOfWeek")
        .orderBy("DayOrdinal")
        .drop("DayOrdinal")
    )


def hourly_basket(sales: DataFrame) -> DataFrame:
    return _basket(sales, F.hour("InvoiceTS"), "Hour").orderBy("Hour")


def price_quantity_bins(sales: DataFrame, bins_per_decade: int = 4) -> DataFrame:
    """Two-dimensional log10 histogram of unit price and quantity (positive values only)."""

    def log_bin(column: str) -> Column:
        return F.floor(F.log10(F.col(column).cast("double")) * bins_per_decade).cast("int")

    positive = sales.filter((F.col("UnitPrice") > 0) & (F.col("Quantity") > 0))
    return positive.groupBy(
        log_bin("UnitPrice").alias("price_bin"), log_bin("Quantity").alias("qty_bin")
    ).agg(
        F.count(F.lit(1)).alias("Lines"),
        F.sum("Quantity").alias("Quantity"),
        _revenue("TotalAmount"),
    )
