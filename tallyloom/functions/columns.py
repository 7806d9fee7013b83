"""Column expressions shared by the operators. All are JVM-side and never throw on bad input."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyloom.schema import INVOICE_DATE_FORMAT


def parse_invoice_ts(column: str = "InvoiceDate", fmt: str = INVOICE_DATE_FORMAT) -> Column:
    """Timestamp, or NULL where the text does not follow ``fmt`` (also under ANSI mode)."""
    return F.try_to_timestamp(F.col(column), F.lit(fmt))


def parse_invoice_ts_strict(column: str = "InvoiceDate", fmt: str = INVOICE_DATE_FORMAT) -> Column:
    """Timestamp; a text that does not follow ``fmt`` fails the job, whatever the ANSI setting."""
    text = F.col(column)
    failure = F.raise_error(F.concat(F.lit("unparseable invoice date: "), text)).cast("timestamp")
    return F.when(text.isNotNull(), F.coalesce(parse_invoice_ts(column, fmt), failure))


def is_cancelled(column: str = "InvoiceNo") -> Column:
    return F.col(column).startswith("C")


def has_positive_value() -> Column:
    return (F.col("Quantity") > 0) & (F.col("UnitPrice") > 0)


def normalized_customer_id(column: str = "CustomerID") -> Column:
    """``17850.0`` and ``17850`` both become ``17850``; blank or non-numeric ids become NULL."""
    return F.col(column).try_cast("double").try_cast("bigint").cast("string")


def total_amount() -> Column:
    return F.col("Quantity") * F.col("UnitPrice")


def year_month(column: str = "InvoiceTS") -> Column:
    return F.date_format(F.col(column), "yyyy-MM")


def weekday(column: str = "InvoiceTS") -> Column:
    return F.date_format(F.col(column), "EEEE")


def months_since(later: str, earlier: str) -> Column:
    """Whole calendar months between two timestamps, counted from 1."""
    gap = (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    return (gap + 1).cast("int")


def money(column: Column) -> Column:
    return F.round(column, 2)


def money_mean(column: str) -> Column:
    """Mean in whole cents; binary noise is rounded off first, so that exact half cents go up."""
    return money(F.round(F.avg(column), 6))


def share_pct(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 6)
