"""Time the headline operators on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print one JSON line.

The raw, cleaned and segment tables are written to a temporary folder first, outside the timing. Each
operator runs once to warm up and then ``$BENCH_RUNS`` times into the noop sink; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
import uuid
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, SparkSession

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
from tallyloom.plans import catalog, star_schema as star
from tallyloom.plans.runs import preprocess_modular
from tallyloom.sources import segment_store


REGISTERED = ["sales_monthly", "stage_counts", "minmax_quantity", "quality_examples", "numeric_summary", "cohort_assign", "src_csv_multiline"]


def cases(spark: SparkSession, sf: str, work: str) -> dict[str, Callable[[], DataFrame]]:
    def stored(name: str, df: DataFrame) -> DataFrame:
        path = f"{work}/{name}"
        df.repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        return spark.read.parquet(path)

    raw = stored("raw", catalog.raw(spark, sf))
    sales = stored("sales", enrichment.add_total_amount(cleaning.clean_modular(raw)))
    profiles = stored("profiles", customers.compute_rfm(sales))
    frame = stored("segments", star.fixed_segments(spark, sf, profiles))
    insight = stored("insight", insights.insight_frame(sales, frame))
    documents = stored("documents", segment_store.segment_documents(frame, "Cluster", "Segment"))
    batch = stored("batch", documents.where("pmod(xxhash64(_id), 3) = 0"))
    regions = star.region_table(spark, sf)
    registered = catalog.queries()
    coded = features.encode_by_frequency(sales, "Country", "Country_Encoded")
    wide = stored("wide-profiles", customers.compute_rfm(coded, extra_features=["Country_Encoded"]))
    store = segment_store.SegmentStore(spark, f"{work}/store-{uuid.uuid4().hex}")
    store.upsert(documents)

    def upsert() -> DataFrame:
        return store.read(store.upsert(batch))

    return {
        "clean_modular": lambda: cleaning.clean_modular(raw),
        "clean_dashboard": lambda: cleaning.clean_dashboard(raw, on_bad_date="null"),
        "region_left_join": lambda: enrichment.add_region(cleaning.clean_minimal(raw), regions),
        "missing_values": lambda: quality.missing_values(raw),
        "quality_counts": lambda: quality.quality_counts(raw),
        "quality_examples": lambda: quality.quality_examples(raw),
        "cancel_trend_monthly": lambda: quality.cancel_trend_monthly(raw),
        "numeric_summary": lambda: quality.numeric_summary(sales),
        "sales_daily": lambda: trends.sales_daily(sales),
        "sales_monthly": lambda: trends.sales_monthly(sales),
        "dow_sales_ordered": lambda: trends.dow_sales_ordered(sales),
        "hourly_sales": lambda: trends.hourly_sales(sales),
        "top_products": lambda: trends.top_products(sales),
        "daily_transactions_ma7": lambda: trends.daily_transactions_ma(sales),
        "kpi_sales": lambda: trends.kpi_sales(sales),
        "price_quantity_bins": lambda: trends.price_quantity_bins(sales),
        "rfm": lambda: customers.compute_rfm(sales),
        "top_customers": lambda: customers.top_customers(sales),
        "customer_country": lambda: customers.customer_country(sales),
        "cohort_retention": lambda: cohorts.cohort_retention(sales),
        "cohort_ltv": lambda: cohorts.cohort_ltv(sales),
        "cohort_assign": lambda: cohorts.cohort_assign(sales),
        "insight_frame": lambda: insights.insight_frame(sales, frame),
        "churn_risk": lambda: insights.churn_risk(insight),
        "vip_top_products": lambda: insights.vip_top_products(sales, insight),
        "vip_share_by_country": lambda: insights.vip_share_by_country(sales, insight),
        "cancellations_by_segment": lambda: segments.cancellations_by_segment(raw, frame),
        "segment_monetary_box": lambda: segments.segment_box_stats(frame),
        "segments_upsert": upsert,
        "zscore_price": lambda: features.z_score_scale(sales, {"UnitPrice": "UnitPrice_Standardized"}),
        "preprocess_modular": lambda: preprocess_modular(raw, regions),
        "silhouette": lambda: clustering.silhouette(frame, cluster="Cluster"),
        "davies_bouldin": lambda: clustering.davies_bouldin(frame, cluster="Cluster"),
        "rfm_kmeans": lambda: clustering.rfm_kmeans(wide, 5).assignments,
        "kmeans_rfm3": lambda: clustering.kmeans_rfm3(profiles, 4).assignments,
        # as registered, with the five-table join
        **{f"query_{name}": (lambda name=name: registered[name](spark, sf)) for name in REGISTERED},
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians, spread, rows = {}, {}, {}
    with tempfile.TemporaryDirectory(prefix="bench-") as work:
        for name, build in cases(spark, sf, work).items():
            times = []
            for _ in range(runs + 1):
                start = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                times.append(time.perf_counter() - start)
            rows[name] = build().count()
            medians[name] = round(statistics.median(times[1:]), 3)
            spread[name] = round(max(times[1:]) - min(times[1:]), 3)
        lines = spark.read.parquet(f"{work}/raw").count()
    print(
        json.dumps(
            {
                "metric": "sum of median operator times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": sf.rsplit("sf", 1)[-1],
                "spread": spread,
                "raw_lines": lines,
                "rows": rows,
                "runs": runs,
                "spark": pyspark.__version__,
                "cpus": int(cpus),
                "adaptive": spark.conf.get("spark.sql.adaptive.enabled"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
