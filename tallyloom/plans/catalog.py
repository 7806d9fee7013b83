"""Registered queries: every operator over the transaction lines derived from a star schema folder.

Results that a sum of doubles can disturb in the last digit are rounded: money to 2, ratios to 6 places.
Joined frames that a query reads more than once are stored first, with the columns it needs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.columns import normalized_customer_id
from tallyloom.functions.staging import stage, stage_path
from tallyloom.operators import (
    cleaning,
    clustering,
    cohorts,
    customers,
    enrichment,
    features,
    insights,
    quality,
    segments,
    trends,
)
from tallyloom.plans import runs, star_schema as star
from tallyloom.schema import EXPORT_COLUMNS, MINIMAL_EXPORT_COLUMNS, RAW_COLUMNS
from tallyloom.sources import readers, sales_store, segment_store, writers

Query = Callable[[SparkSession, str], DataFrame]

FILTER_START, FILTER_END = dt.date(1996, 1, 1), dt.date(1998, 12, 31)
FILTER_COUNTRIES = [f"nation_{i}" for i in range(5)]
REFERENCE_DATE = "2001-12-10"
# So small that the files of the smallest tables are cut, too.
MULTI_LINE_RANGE = 1 << 18
# The stored segments come from the sales before this date, the upserted ones from the sales since.
STORE_UNTIL = "1998-01-01"


# --- input frames ---


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return star.raw_transactions(spark, sf)


def sales(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.add_total_amount(cleaning.clean_modular(raw(spark, sf)))


def dashboard(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_dashboard(raw(spark, sf), on_bad_date="null")


def event_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Events as sales lines of one unit; a user's events form one invoice that spans many days."""
    return star.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("InvoiceNo"),
        F.lit(1).alias("Quantity"),
        F.col("ts").cast("timestamp").alias("InvoiceTS"),
        F.col("value").alias("TotalAmount"),
    )


def stored_sales(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Stored sales with the columns of customer profiles and ``more``."""
    columns = ["CustomerID", "InvoiceNo", "InvoiceTS", "Quantity", "TotalAmount", *more]
    return stage(sales(spark, sf).select(*columns), "sales")


def segments_of(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    return star.fixed_segments(spark, sf, customers.compute_rfm(lines))


def segment_frame(spark: SparkSession, sf: str) -> DataFrame:
    return stage(segments_of(spark, sf, stored_sales(spark, sf)), "segments")


def insight_of(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    return stage(insights.insight_frame(lines, segments_of(spark, sf, lines)), "insight")


def insight(spark: SparkSession, sf: str) -> DataFrame:
    return insight_of(spark, sf, stored_sales(spark, sf))


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    encoded = features.encode_by_frequency(stored_sales(spark, sf, "Country"), "Country", "Country_Encoded")
    return customers.compute_rfm(encoded, extra_features=["Country_Encoded"])


def _r(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- sources and sinks ---


def _csv_copy(spark: SparkSession, sf: str, encoding: str = "UTF-8") -> str:
    path = stage_path(spark, "raw-csv")
    raw(spark, sf).write.options(
        header=True,
        quote='"',
        escape='"',
        encoding=encoding,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


def src_csv_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_transactions_csv(spark, _csv_copy(spark, sf))


def src_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_transactions_csv(spark, _csv_copy(spark, sf), infer_schema=True)


def src_csv_latin1(spark: SparkSession, sf: str) -> DataFrame:
    path = _csv_copy(spark, sf, "ISO-8859-1")
    return readers.read_transactions_csv(spark, path, encoding="ISO-8859-1")


def multi_line_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines of which every other product has a quoted name over several lines."""
    broken = F.concat(F.lit('"'), F.translate("Description", " ", "\n"), F.lit('",\n'))
    odd = F.col("StockCode").cast("int") % 2 == 1
    return raw(spark, sf).withColumn("Description", F.when(odd, broken).otherwise(F.col("Description")))


def src_csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "multi-line-csv")
    writers.export_csv(multi_line_lines(spark, sf), path, RAW_COLUMNS)
    return readers.read_transactions_csv(spark, path, multi_line=True, range_bytes=MULTI_LINE_RANGE)


def _exported(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of an export, written and read back."""
    path = stage_path(frame.sparkSession, "export")
    writers.export_csv(frame, path, columns)
    # with a mark of its own for nulls the reader keeps empty texts, which are written in quotes, apart from them
    return frame.sparkSession.read.csv(path, header=True, escape='"', nullValue="\0", schema=frame.select(*columns).schema)


def _export_modular(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(runs.preprocess_modular(raw(spark, sf), star.region_table(spark, sf)), EXPORT_COLUMNS)


def _export_minimal(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(runs.preprocess_minimal(raw(spark, sf), star.region_table(spark, sf)), MINIMAL_EXPORT_COLUMNS)


def export_csv_modular(spark: SparkSession, sf: str) -> DataFrame:
    return _r(_export_modular(spark, sf), 6, "Quantity_Normalized", "UnitPrice_Standardized")


def export_csv_minimal(spark: SparkSession, sf: str) -> DataFrame:
    return _export_minimal(spark, sf)


def export_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Figures of both exports by region; their rows are checked by the two queries above."""
    summaries = [
        back.groupBy(F.lit(name).alias("export"), "Region").agg(
            F.count(F.lit(1)).alias("lines"),
            F.countDistinct("InvoiceNo").alias("invoices"),
            F.sum("Quantity").cast("bigint").alias("quantity"),
            F.round(F.sum("TotalAmount"), 2).alias("amount"),
        )
        for name, back in (("modular", _export_modular(spark, sf)), ("minimal", _export_minimal(spark, sf)))
    ]
    return summaries[0].union(summaries[1])


def segments_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The nested documents, each field under its path."""
    stored = stage(_documents(spark, sf), "documents")
    paths = ["_id", "rfm.recency", "rfm.frequency", "rfm.monetary", "segment.cluster_id", "segment.label"]
    return _r(stored.select(*[F.col(p).alias(p.replace(".", "_")) for p in paths]), 2, "rfm_monetary")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return segment_store.segment_documents(segment_frame(spark, sf), "Cluster", "Segment")


def segments_flatten(spark: SparkSession, sf: str) -> DataFrame:
    documents = stage(_documents(spark, sf), "documents")
    return _r(readers.flatten_segments(documents), 2, "Monetary")


def segments_upsert(spark: SparkSession, sf: str) -> DataFrame:
    lines = stored_sales(spark, sf)

    def documents(part: Column) -> DataFrame:
        frame = segments_of(spark, sf, lines.filter(part))
        return segment_store.segment_documents(frame, "Cluster", "Segment")

    cutoff = F.lit(STORE_UNTIL).cast("timestamp")
    store = segment_store.SegmentStore(spark, stage_path(spark, "store"))
    store.upsert(documents(F.col("InvoiceTS") < cutoff))
    store.upsert(documents(F.col("InvoiceTS") >= cutoff))
    return _r(readers.flatten_segments(store.read()), 2, "Monetary")


# --- filters and projections ---


def filter_date_country(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.filter_date_country(dashboard(spark, sf), FILTER_START, FILTER_END, FILTER_COUNTRIES)


def filter_sales_by_month(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sales-by-month")
    writers.write_sales(sales(spark, sf), path)
    return sales_store.read_sales(spark, path, FILTER_START, FILTER_END, star.DEFAULTS)


def filter_domain_stored(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sales-by-month")
    writers.write_sales(sales(spark, sf), path)
    return sales_store.stored_filter_domain(spark, path, defaults=star.DEFAULTS)


def region_case(spark: SparkSession, sf: str) -> DataFrame:
    lines = star.raw_transactions(spark, sf, country=star.real_countries())
    mapped = enrichment.add_region(cleaning.clean_modular(lines))
    return mapped.groupBy("Country", "Region").agg(F.count(F.lit(1)).alias("lines"))


def region_left_join(spark: SparkSession, sf: str) -> DataFrame:
    lines = cleaning.clean_minimal(raw(spark, sf))
    return enrichment.add_region(lines, star.region_table(spark, sf))


def normalize_customer_id(spark: SparkSession, sf: str) -> DataFrame:
    return (
        raw(spark, sf)
        .groupBy("CustomerID")
        .agg(F.count(F.lit(1)).alias("lines"))
        .withColumn("normalized_id", normalized_customer_id())
    )


def label_clusters(spark: SparkSession, sf: str) -> DataFrame:
    numbered = star.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustomerID"), (F.col("c_custkey") % 7).cast("int").alias("cluster")
    )
    named = clustering.label_clusters(numbered)
    return named.withColumn("Segment", clustering.segment_name())


def preview_raw_clean(spark: SparkSession, sf: str) -> DataFrame:
    first_raw = enrichment.preview(raw(spark, sf)).select(F.lit("raw").alias("frame"), *RAW_COLUMNS)
    first_clean = enrichment.preview(dashboard(spark, sf).select(*RAW_COLUMNS))
    return first_raw.union(first_clean.select(F.lit("clean"), *RAW_COLUMNS))


# --- aggregates over stored frames ---


def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines = dashboard(spark, sf).select("Quantity", "UnitPrice", "TotalAmount")
    return quality.numeric_summary(stage(lines, "numeric"))


def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    lines = stage(raw(spark, sf), "raw")
    return quality.stage_counts(lines, cleaning.clean_modular(lines))


def quality_examples(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_examples(stage(raw(spark, sf), "raw"))


def cohort_retention_wide(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.cohort_retention_wide(sales(spark, sf))


def vip_share_by_country_wide(spark: SparkSession, sf: str) -> DataFrame:
    lines = stored_sales(spark, sf, "StockCode", "Country")
    return insights.vip_share_by_country_wide(lines, insight_of(spark, sf, lines), star.SEGMENTS)


def kpi_sales(spark: SparkSession, sf: str) -> DataFrame:
    return trends.kpi_sales(sales(spark, sf))


def rfm(spark: SparkSession, sf: str) -> DataFrame:
    return _r(customers.compute_rfm(stored_sales(spark, sf)), 2, "Monetary")


def rfm_fixed_date(spark: SparkSession, sf: str) -> DataFrame:
    return _r(customers.compute_rfm(sales(spark, sf), REFERENCE_DATE), 2, "Monetary")


def rfm_encoded(spark: SparkSession, sf: str) -> DataFrame:
    return _r(profiles(spark, sf), 2, "Monetary")


def cohort_assign(spark: SparkSession, sf: str) -> DataFrame:
    return cohorts.cohort_assign(stage(sales(spark, sf), "sales"))


def cancellations_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return segments.cancellations_by_segment(raw(spark, sf), segment_frame(spark, sf))


def insight_frame(spark: SparkSession, sf: str) -> DataFrame:
    return _r(insight(spark, sf), 2, "TotalAmount", "Monetary")


def churn_risk(spark: SparkSession, sf: str) -> DataFrame:
    return _r(_r(insights.churn_risk(insight(spark, sf)), 2, "Monetary"), 6, "Threshold")


def vip_top_products(spark: SparkSession, sf: str) -> DataFrame:
    lines = stored_sales(spark, sf, "Description")
    return insights.vip_top_products(lines, insight_of(spark, sf, lines))


def vip_share_by_country(spark: SparkSession, sf: str) -> DataFrame:
    lines = stored_sales(spark, sf, "StockCode", "Country")
    return insights.vip_share_by_country(lines, insight_of(spark, sf, lines))


# --- features and clusters ---


def encode_country(spark: SparkSession, sf: str) -> DataFrame:
    return features.frequency_index(sales(spark, sf), "Country", "Country_Encoded")[0]


def encode_region(spark: SparkSession, sf: str) -> DataFrame:
    return features.frequency_index(region_left_join(spark, sf), "Region", "Region_Encoded")[0]


def minmax_quantity(spark: SparkSession, sf: str) -> DataFrame:
    scaled = features.min_max_scale(stage(sales(spark, sf), "sales"), "Quantity", "Quantity_Normalized")
    return _r(scaled.select(*RAW_COLUMNS, "Quantity_Normalized"), 6, "Quantity_Normalized")


def zscore_price(spark: SparkSession, sf: str) -> DataFrame:
    scaled = features.z_score_scale(stage(sales(spark, sf), "sales"), {"UnitPrice": "UnitPrice_Standardized"})
    return _r(scaled.select(*RAW_COLUMNS, "UnitPrice_Standardized"), 6, "UnitPrice_Standardized")


def preprocess_modular(spark: SparkSession, sf: str) -> DataFrame:
    frame = runs.preprocess_modular(raw(spark, sf), star.region_table(spark, sf))
    return _r(frame, 6, "Quantity_Normalized", "UnitPrice_Standardized")


def preprocess_monolith(spark: SparkSession, sf: str) -> DataFrame:
    frame = runs.preprocess_minimal(raw(spark, sf), star.region_table(spark, sf))
    return frame.select(*MINIMAL_EXPORT_COLUMNS)


def rfm_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    run = clustering.rfm_kmeans(profiles(spark, sf), 5)
    checked = clustering.label_clusters(clustering.check_labels(run, clustering.PROFILE_FEATURES, population=False))
    return _labelled(checked.withColumnRenamed("segment_label", "Segment"), 5)


def _labelled(checked: DataFrame, k: int) -> DataFrame:
    """Each customer's figures, whether its centre is the nearest one and whether its label names the cluster.

    Which cluster gets which number depends on the seeds, so the numbers are checked and not compared."""
    fits = F.col("cluster").between(0, k - 1) & (F.col("Segment") == clustering.segment_name())
    columns = ["CustomerID", *[F.col(f).cast("double").alias(f) for f in clustering.RFM_FEATURES]]
    return _r(checked.withColumn("label_fits", fits).select(*columns, "is_nearest", "label_fits"), 2, "Monetary")


def _best_of_ten(spark: SparkSession, sf: str) -> clustering.ClusterRun:
    return clustering.kmeans_rfm3(customers.compute_rfm(stored_sales(spark, sf)), k=4)


def kmeans_rfm3(spark: SparkSession, sf: str) -> DataFrame:
    checked = clustering.check_labels(_best_of_ten(spark, sf), clustering.RFM_FEATURES, population=True)
    return _labelled(checked.withColumn("Segment", clustering.segment_name()), 4)


def _library_silhouette(run: clustering.ClusterRun) -> float:
    """The silhouette that Spark's evaluator gives the returned rows."""
    names = [f"z_{f}" for f in clustering.RFM_FEATURES]
    rows = features.z_score_scale(run.assignments, dict(zip(clustering.RFM_FEATURES, names, strict=True)), population=True)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows.select("cluster", *names))
    return ClusteringEvaluator(predictionCol="cluster").evaluate(vectors)


def kmeans_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The reported measures, each one as whether it equals the figure worked out from labels and centres."""
    run = _best_of_ten(spark, sf)
    checked = stage(clustering.check_labels(run, clustering.RFM_FEATURES, population=True), "checked")
    again = checked.agg(F.sum("distance").alias("d"), F.count(F.lit(1)).alias("n"), F.countDistinct("cluster").alias("c"))
    davies = clustering.davies_bouldin(checked).groupBy().agg(F.max("score")).scalar()
    calinski = clustering.calinski_harabasz(checked).groupBy().agg(F.max("score")).scalar()
    metrics = clustering.cluster_metrics(run).crossJoin(F.broadcast(again))  # one row each
    # Within and between sums of squares on standardised features add up to features times customers.
    total = F.lit(float(len(clustering.RFM_FEATURES))) * F.col("n")
    ratio = ((total - F.col("d")) / (F.col("k") - 1)) / (F.col("d") / (F.col("n") - F.col("k")))
    return metrics.select(
        F.col("k").cast("int").alias("k"),
        F.col("n").alias("customers"),
        (F.abs(F.col("sse") - F.col("d")) <= F.col("d") * 1e-6).alias("sse_fits"),
        (F.abs(F.col("silhouette") - _library_silhouette(run)) <= 1e-6).alias("silhouette_fits"),
        (F.col("davies_bouldin") == davies).alias("davies_bouldin_fits"),
        # centres are means up to the tolerance of the iterations
        (F.abs(calinski / ratio - 1) <= 0.01).alias("calinski_harabasz_fits"),
    )


def cluster_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """Each segment's centre: whether it is the mean of its members, up to the tolerance of the iterations."""
    run = _best_of_ten(spark, sf)
    named = run.assignments.withColumn("Segment", clustering.segment_name())
    centres = clustering.cluster_centroids(run)
    means = named.groupBy("Segment").agg(*[F.avg(f).alias(f"mean_{f}") for f in clustering.RFM_FEATURES])
    scale = run.assignments.agg(F.struct(*[F.stddev_pop(f).alias(f) for f in clustering.RFM_FEATURES])).scalar()
    near = [
        F.abs(F.col(f) - F.col(f"mean_{f}")) <= F.col("scale")[f] * 0.02 for f in clustering.RFM_FEATURES
    ]
    joined = centres.join(means, "Segment", "left").withColumn("scale", scale)
    return joined.select("Segment", F.coalesce(near[0] & near[1] & near[2], F.lit(False)).alias("is_mean"))


def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The number of segments, whether none is empty, and the customers in all of them."""
    sizes = clustering.cluster_sizes(_best_of_ten(spark, sf).assignments)
    return sizes.agg(
        F.count(F.lit(1)).alias("segments"),
        (F.min("Customers") > 0).alias("none_empty"),
        F.sum("Customers").alias("customers"),
    )


def davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.davies_bouldin(segment_frame(spark, sf), cluster="Cluster")


def calinski_harabasz(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.calinski_harabasz(segment_frame(spark, sf), cluster="Cluster")


def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.silhouette(segment_frame(spark, sf), cluster="Cluster")


def silhouette_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    return clustering.silhouette_euclidean(segment_frame(spark, sf), cluster="Cluster")


def _run_summary(result: runs.RunResult, k: int) -> DataFrame:
    """Stored profiles of a whole run, and whether each one carries the name and number of its nearest centre."""
    checked = clustering.check_labels(result.clusters, clustering.PROFILE_FEATURES, population=False)
    nearest = checked.select("CustomerID", "cluster", "is_nearest").withColumnsRenamed({"cluster": "own"})
    named = (F.col("Cluster") == F.col("own")) & (F.col("Segment") == clustering.segment_name("own"))
    stored = readers.flatten_segments(result.segments).join(nearest, "CustomerID", "left")
    fits = F.coalesce(F.col("is_nearest") & named & F.col("own").between(0, k - 1), F.lit(False))
    rows = stored.withColumn("is_labelled", fits).drop("Cluster", "Segment", "own", "is_nearest")
    return _r(rows, 2, "Monetary")


def end_to_end_full(spark: SparkSession, sf: str) -> DataFrame:
    result = runs.run_full(
        raw(spark, sf),
        k=5,
        export_path=stage_path(spark, "export"),
        store_path=stage_path(spark, "store"),
        regions=star.region_table(spark, sf),
    )
    return _run_summary(result, 5)


def end_to_end_basic(spark: SparkSession, sf: str) -> DataFrame:
    return _run_summary(runs.run_basic(raw(spark, sf), k=4, store_path=stage_path(spark, "store")), 4)


# --- registry ---


def _on(frame: Query, operator: Callable[..., DataFrame], **options: object) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return operator(frame(spark, sf), **options)

    return query


def queries() -> dict[str, Query]:
    return {
        "src_csv_fixed": src_csv_fixed,
        "src_csv_inferred": src_csv_inferred,
        "src_csv_latin1": src_csv_latin1,
        "src_csv_multiline": src_csv_multiline,
        "export_csv_modular": export_csv_modular,
        "export_csv_minimal": export_csv_minimal,
        "export_csv_roundtrip": export_csv_roundtrip,
        "segments_documents": segments_documents,
        "segments_flatten": segments_flatten,
        "segments_upsert": segments_upsert,
        "clean_modular": _on(raw, cleaning.clean_modular),
        "clean_basic": _on(raw, cleaning.clean_basic),
        "clean_basic_keep_null_customer": _on(raw, cleaning.clean_basic, drop_null_customer=False),
        "clean_minimal": _on(raw, cleaning.clean_minimal),
        "clean_dashboard": dashboard,
        "cleaning_loss_report": _on(raw, cleaning.cleaning_loss_report),
        "volume_comparison": _on(raw, cleaning.volume_comparison),
        "cancellations": _on(raw, quality.cancelled_lines),
        "filter_date_country": filter_date_country,
        "filter_sales_by_month": filter_sales_by_month,
        "filter_domain": _on(sales, enrichment.filter_domain, defaults=star.DEFAULTS),
        "filter_domain_stored": filter_domain_stored,
        "filter_domain_fallback": _on(dashboard, enrichment.filter_domain),
        "region_left_join": region_left_join,
        "region_case": region_case,
        "total_amount": sales,
        "normalize_customer_id": normalize_customer_id,
        "label_clusters": label_clusters,
        "preview_raw_clean": preview_raw_clean,
        "missing_values": _on(raw, quality.missing_values),
        "cancel_share": _on(raw, quality.cancel_share),
        "top_returned_products": _on(raw, quality.top_returned_products),
        "cancel_trend_monthly": _on(raw, quality.cancel_trend_monthly),
        "numeric_summary": numeric_summary,
        "quality_counts": _on(raw, quality.quality_counts),
        "quality_examples": quality_examples,
        "stage_counts": stage_counts,
        "sales_daily": _on(sales, trends.sales_daily),
        "sales_monthly": _on(sales, trends.sales_monthly),
        "monthly_revenue": _on(sales, trends.monthly_revenue),
        "dow_sales": _on(sales, trends.dow_sales),
        "dow_sales_ordered": _on(sales, trends.dow_sales_ordered),
        "hourly_sales": _on(sales, trends.hourly_sales),
        "country_revenue": _on(sales, trends.country_revenue),
        "product_sales": _on(sales, trends.product_sales),
        "top_products": _on(sales, trends.top_products),
        "home_vs_international": _on(sales, trends.home_vs_international, home_country=star.HOME),
        "top_international": _on(sales, trends.top_international, home_country=star.HOME),
        "daily_transactions_ma7": _on(sales, trends.daily_transactions_ma),
        "kpi_sales": kpi_sales,
        "dow_basket": _on(sales, trends.dow_basket),
        "hourly_basket": _on(sales, trends.hourly_basket),
        "events_hourly": _on(event_sales, trends.hourly_sales),
        "events_daily_ma7": _on(event_sales, trends.daily_transactions_ma),
        "events_dow_basket": _on(event_sales, trends.dow_basket),
        "events_kpi": _on(event_sales, trends.kpi_sales),
        "filtered_monthly_revenue": _on(filter_date_country, trends.monthly_revenue),
        "filtered_cohort_counts": _on(filter_date_country, cohorts.cohort_counts),
        "price_quantity_bins": _on(sales, trends.price_quantity_bins),
        "rfm": rfm,
        "rfm_fixed_date": rfm_fixed_date,
        "rfm_encoded": rfm_encoded,
        "top_customers": _on(sales, customers.top_customers),
        "customer_country": _on(sales, customers.customer_country),
        "kpi_customers": _on(segment_frame, customers.kpi_customers),
        "repeat_purchase": _on(insight, customers.repeat_purchase),
        "loyalty_effect": _on(insight, customers.loyalty_effect),
        "loyalty_caps": _on(insight, insights.loyalty_caps),
        "cohort_assign": cohort_assign,
        "cohort_counts": _on(sales, cohorts.cohort_counts),
        "cohort_retention": _on(sales, cohorts.cohort_retention),
        "cohort_retention_wide": cohort_retention_wide,
        "cohort_ltv": _on(sales, cohorts.cohort_ltv),
        "insight_frame": insight_frame,
        "pareto_segments": _on(insight, insights.pareto_segments),
        "churn_risk": churn_risk,
        "vip_segment": _on(insight, insights.vip_segment),
        "vip_top_products": vip_top_products,
        "vip_share_by_country": vip_share_by_country,
        "vip_share_by_country_wide": vip_share_by_country_wide,
        "cancellations_by_segment": cancellations_by_segment,
        "segment_monetary_box": _on(segment_frame, segments.segment_box_stats),
        "encode_country": encode_country,
        "encode_region": encode_region,
        "minmax_quantity": minmax_quantity,
        "zscore_price": zscore_price,
        "preprocess_modular": preprocess_modular,
        "preprocess_monolith": preprocess_monolith,
        "davies_bouldin": davies_bouldin,
        "calinski_harabasz": calinski_harabasz,
        "silhouette": silhouette,
        "silhouette_euclidean": silhouette_euclidean,
        "rfm_kmeans": rfm_kmeans,
        "kmeans_rfm3": kmeans_rfm3,
        "kmeans_metrics": kmeans_metrics,
        "cluster_centroids": cluster_centroids,
        "cluster_sizes": cluster_sizes,
        "end_to_end_full": end_to_end_full,
        "end_to_end_basic": end_to_end_basic,
    }
