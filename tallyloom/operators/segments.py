"""Descriptions of a labelled customer base."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import is_cancelled, normalized_customer_id
from tallyloom.functions.joins import skew_join
from tallyloom.functions.quantiles import percentiles
from tallyloom.functions.staging import stage


def segment_box_stats(segments: DataFrame, value: str = "Monetary") -> DataFrame:
    """Box-plot figures of ``value`` per segment.

    Whiskers end at the outermost values within 1.5 interquartile ranges of the box; the values beyond
    them are counted as outliers. ``segments`` is read several times; hand in a stored table.
    """
    box = percentiles(segments, [value], [0.25, 0.5, 0.75], by=["Segment"]).drop("column_name")
    reach = (F.col("p75") - F.col("p25")) * 1.5
    x = F.col("x")
    inside = x.between(F.col("p25") - reach, F.col("p75") + reach)
    points = segments.select("Segment", F.col(value).cast("double").alias("x")).dropna()
    return (
        points.join(box, "Segment")
        .groupBy("Segment", "p25", "p50", "p75")
        .agg(
            F.round(F.min(F.when(inside, x)), 2).alias("whisker_low"),
            F.round(F.max(F.when(inside, x)), 2).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(
            "Segment",
            F.round("p25", 2).alias("q1"),
            F.round("p50", 2).alias("median"),
            F.round("p75", 2).alias("q3"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )


def cancellations_by_segment(raw: DataFrame, segments: DataFrame) -> DataFrame:
    """Distinct cancelled invoices per segment, most first.

    Lines shrink to distinct (customer, invoice) pairs before the join; a customer that still owns a
    large share of them is split over several tasks.
    """
    pairs = stage(
        raw.filter(is_cancelled())
        .select(normalized_customer_id().alias("CustomerID"), "InvoiceNo")
        .filter(F.col("CustomerID").isNotNull())
        .distinct(),
        "cancelled-invoices",
    )
    labels = segments.select(normalized_customer_id().alias("CustomerID"), "Segment")
    return (
        skew_join(pairs, labels, "CustomerID")
        .filter(F.col("Segment").isNotNull())
        .groupBy("Segment")
        .agg(F.countDistinct("InvoiceNo").alias("CancelledInvoices"))
        .orderBy(F.desc("CancelledInvoices"), "Segment")
    )
