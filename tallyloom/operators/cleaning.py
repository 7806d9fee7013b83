"""Four named cleaning rules for raw transaction lines.

They differ on purpose; each keeps exactly the rows its profile asks for:

* ``clean_modular``  drops missing descriptions and customers *before* trimming (blank ids survive)
* ``clean_basic``    trims first, then drops missing and blank customers (optional)
* ``clean_minimal``  drops missing values and non-positive quantities only
* ``clean_dashboard`` drops missing customers and non-positive quantities, adds calendar columns
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import (
    has_positive_value,
    is_cancelled,
    parse_invoice_ts,
    parse_invoice_ts_strict,
    share_pct,
    total_amount,
    weekday,
    year_month,
)
from tallyloom.schema import INVOICE_DATE_FORMAT, TEXT_COLUMNS


def _trimmed(raw: DataFrame) -> DataFrame:
    return raw.withColumns({name: F.trim(F.col(name)) for name in TEXT_COLUMNS})


def _valid_sales(df: DataFrame, fmt: str) -> DataFrame:
    dated = df.withColumn("InvoiceTS", parse_invoice_ts(fmt=fmt))
    # cheap conditions first: they spare most rejected lines the parsing
    return dated.filter(~is_cancelled() & has_positive_value() & F.col("InvoiceTS").isNotNull())


def clean_modular(raw: DataFrame, fmt: str = INVOICE_DATE_FORMAT) -> DataFrame:
    present = raw.dropna(subset=["Description", "CustomerID"])
    return _valid_sales(_trimmed(present).withColumn("Country", F.upper("Country")), fmt)


def clean_basic(
    raw: DataFrame, drop_null_customer: bool = True, fmt: str = INVOICE_DATE_FORMAT
) -> DataFrame:
    sales = _valid_sales(_trimmed(raw), fmt)
    return sales.filter(F.col("CustomerID") != "") if drop_null_customer else sales


def clean_minimal(raw: DataFrame) -> DataFrame:
    present = raw.dropna(subset=["Description", "CustomerID"])
    return present.withColumn("Country", F.upper("Country")).filter(F.col("Quantity") > 0)


def clean_dashboard(
    raw: DataFrame, on_bad_date: str = "fail", fmt: str = INVOICE_DATE_FORMAT
) -> DataFrame:
    """``on_bad_date``: ``fail`` stops at an unreadable date, ``null`` leaves its calendar columns empty."""
    if on_bad_date not in ("fail", "null"):
        raise ValueError("on_bad_date must be 'fail' or 'null'")
    parse = parse_invoice_ts_strict if on_bad_date == "fail" else parse_invoice_ts
    kept = raw.filter(_dashboard_rows()).withColumn("InvoiceTS", parse(fmt=fmt))
    return kept.withColumns(
        {
            "TotalAmount": total_amount(),
            "MonthStr": year_month(),
            "DayOfWeek": weekday(),
            "Hour": F.hour("InvoiceTS"),
        }
    )


def _dashboard_rows() -> Column:
    return F.col("CustomerID").isNotNull() & (F.col("Quantity") > 0)


def volume_comparison(raw: DataFrame) -> DataFrame:
    """Line counts before and after the dashboard rule, in one pass."""
    return raw.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(_dashboard_rows()).alias("rows_after")
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def cleaning_loss_report(raw: DataFrame) -> DataFrame:
    """Loss by missing values, and lines left once non-positive quantities are gone, in one pass."""
    present = F.col("Description").isNotNull() & F.col("CustomerID").isNotNull()
    removed = F.col("rows_before") - F.col("rows_after")
    return raw.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(present).alias("rows_after"),
        F.count_if(present & (F.col("Quantity") > 0)).alias("rows_consistent"),
    ).select(
        "rows_before",
        "rows_after",
        removed.alias("rows_removed"),
        share_pct(removed, F.col("rows_before")).alias("removed_pct"),
        "rows_consistent",
    )
