"""Data-quality reports over raw transaction lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.columns import is_cancelled, parse_invoice_ts, share_pct, year_month
from tallyloom.functions.quantiles import percentiles
from tallyloom.schema import INVOICE_DATE_FORMAT, RAW_COLUMNS, TEXT_COLUMNS


def missing_values(df: DataFrame) -> DataFrame:
    """Per column: number and percentage (2 decimals) of NULLs, from one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counted.unpivot(["total"], df.columns, "column_name", "missing_count").select(
        "column_name",
        "missing_count",
        F.round(F.try_divide(F.col("missing_count") * F.lit(100.0), F.col("total")), 2).alias("missing_pct"),
    )


def _cancelled_line() -> Column:
    return F.coalesce(is_cancelled(), F.lit(False))


def cancelled_lines(raw: DataFrame) -> DataFrame:
    return raw.filter(is_cancelled())


def cancel_share(raw: DataFrame) -> DataFrame:
    """Lines and share of cancelled and successful invoices; a missing number counts as successful."""
    counts = raw.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_cancelled_line()).alias("cancelled")
    ).withColumn("successful", F.col("total") - F.col("cancelled"))
    return counts.unpivot(["total"], ["cancelled", "successful"], "status", "lines").select(
        "status", "lines", share_pct(F.col("lines"), F.col("total")).alias("share_pct")
    )


def top_returned_products(raw: DataFrame, n: int = 5) -> DataFrame:
    """Products with the most cancelled lines, ties by name."""
    return (
        cancelled_lines(raw)
        .filter(F.col("Description").isNotNull())
        .groupBy(F.col("Description").alias("Product"))
        .agg(F.count(F.lit(1)).alias("ReturnLines"))
        .orderBy(F.desc("ReturnLines"), "Product")
        .limit(n)
    )


def cancel_trend_monthly(raw: DataFrame, fmt: str = INVOICE_DATE_FORMAT) -> DataFrame:
    """Distinct cancelled invoices per month; lines with an unreadable date are left out."""
    return (
        cancelled_lines(raw)
        .select("InvoiceNo", parse_invoice_ts(fmt=fmt).alias("InvoiceTS"))
        .filter(F.col("InvoiceTS").isNotNull())
        .groupBy(year_month().alias("Month"))
        .agg(F.countDistinct("InvoiceNo").alias("CancelledInvoices"))
        .orderBy("Month")
    )


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str] = ("Quantity", "UnitPrice", "TotalAmount"),
    approx: bool = False,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles per column, 2 decimals.

    ``df`` is read several times; hand in a stored table.
    """

    def moments_of(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(v).alias("count"),
            F.round(F.avg(v), 2).alias("mean"),
            F.round(F.stddev_samp(v), 2).alias("std"),
            F.round(F.min(v), 2).alias("min"),
            F.round(F.max(v), 2).alias("max"),
        )

    moments = df.agg(F.array(*[moments_of(c) for c in columns]).alias("m")).select(F.inline("m"))
    quartiles = percentiles(df, columns, [0.25, 0.5, 0.75], approx=approx).select(
        "column_name", *[F.round(q, 2).alias(q) for q in ("p25", "p50", "p75")]
    )
    # one row per summarised column on both sides
    return moments.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


QUALITY_TAGS = ["trim", "cancel", "invalid_date", "invalid_values", "null_customer", "normal"]


def with_quality_tags(raw: DataFrame, date_length: int = len("yyyy-MM-dd HH:mm:ss")) -> DataFrame:
    """Add one flag per check; a line may fail several checks, ``normal`` means none of them."""
    date = F.coalesce("InvoiceDate", F.lit(""))
    padded = [F.col(c).startswith(" ") | F.col(c).endswith(" ") for c in TEXT_COLUMNS]
    checks = {
        "trim": F.greatest(*[F.coalesce(p, F.lit(False)) for p in padded]),
        "cancel": _cancelled_line(),
        "invalid_date": (F.length(date) < date_length) | ~date.contains("-") | ~date.contains(":"),
        "invalid_values": (F.coalesce("Quantity", F.lit(0)) <= 0) | (F.coalesce("UnitPrice", F.lit(0.0)) <= 0),
        "null_customer": F.coalesce("CustomerID", F.lit("")).rlike(r"^\s*$"),
    }
    return raw.withColumns(checks).withColumn("normal", ~F.greatest(*checks))


def quality_counts(raw: DataFrame) -> DataFrame:
    flagged = with_quality_tags(raw)
    counts = flagged.agg(*[F.count_if(F.col(tag)).alias(tag) for tag in QUALITY_TAGS])
    return counts.unpivot([], QUALITY_TAGS, "category", "rows")


def quality_examples(raw: DataFrame, per_category: int = 3) -> DataFrame:
    """Up to ``per_category`` lines per tag, the first ones by all columns, NULLs first.

    The invoice numbers of the wanted lines are found first from narrow rows, of which each task passes
    on its own first ones only (window group limit). They select the few lines that are sorted in full.
    """
    columns = [c for c in RAW_COLUMNS if c in raw.columns]
    flagged = with_quality_tags(raw).unpivot(columns, QUALITY_TAGS, "category", "tagged")
    tagged = flagged.filter("tagged").drop("tagged")

    def first_rows(df: DataFrame, *order: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("category").orderBy(*order))
        return df.withColumn("rank", rank).filter(F.col("rank") <= per_category)

    leading = first_rows(tagged.select("category", "InvoiceNo"), "InvoiceNo").select(
        F.col("category").alias("tag"), F.col("InvoiceNo").alias("number")
    )
    # at most per_category rows per tag
    wanted = (F.col("category") == F.col("tag")) & F.col("InvoiceNo").eqNullSafe(F.col("number"))
    candidates = tagged.join(F.broadcast(leading), wanted, "left_semi")
    return first_rows(candidates, *columns).select("category", "rank", *columns)


def stage_counts(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Lines read, lines kept by the cleaning rule and customers left, as (stage, rows)."""
    kept = cleaned.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("clean"), F.count(F.lit(1)).alias("customers")
    )
    both = kept.withColumn("raw", raw.groupBy().agg(F.count(F.lit(1))).scalar())
    return both.unpivot([], ["raw", "clean", "customers"], "stage", "rows")
