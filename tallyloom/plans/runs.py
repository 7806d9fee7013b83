"""End-to-end runs: raw lines to exports, aggregates and a segment store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from tallyloom.functions.staging import stage
from tallyloom.operators.cleaning import clean_basic, clean_minimal, clean_modular
from tallyloom.operators.clustering import PROFILE_FEATURES, ClusterRun, label_clusters, rfm_kmeans
from tallyloom.operators.customers import compute_rfm
from tallyloom.operators.enrichment import SEED_REGIONS, add_region, add_total_amount, region_dimension
from tallyloom.operators.features import encode_by_frequency, transform_features
from tallyloom.operators.trends import sales_monthly
from tallyloom.plans.run_log import RunLog, fingerprint
from tallyloom.schema import EXPORT_COLUMNS, MINIMAL_EXPORT_COLUMNS
from tallyloom.sources.segment_store import SegmentStore, segment_documents
from tallyloom.sources.writers import export_csv


@dataclass(frozen=True)
class RunResult:
    sales: DataFrame
    monthly: DataFrame
    profiles: DataFrame
    clusters: ClusterRun
    segments: DataFrame
    stage_rows: dict[str, int]
    log: RunLog


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def preprocess_modular(raw: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Clean, map regions, add amounts, encode countries and scale: the 14 export columns.

    The cleaned lines are stored once, so that fitting the encoder and the scalers reads single columns
    of that table instead of repeating the cleaning.
    """
    return _featured(stage(add_total_amount(add_region(clean_modular(raw), regions)), "clean-sales"))


def _featured(sales: DataFrame) -> DataFrame:
    encoded = encode_by_frequency(transform_features(sales), "Country", "Country_Encoded")
    return encoded.select(*EXPORT_COLUMNS)


def preprocess_minimal(raw: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """Short preprocessing run: minimal cleaning, seed regions, region index, plus both scaled columns.

    Export it with ``MINIMAL_EXPORT_COLUMNS``.
    """
    dimension = region_dimension(raw.sparkSession, SEED_REGIONS) if regions is None else regions
    sales = stage(add_total_amount(add_region(clean_minimal(raw), dimension)), "minimal-sales")
    scaled = transform_features(sales)
    encoded = encode_by_frequency(scaled, "Region", "Region_Encoded", on_missing="error")
    return encoded.select(
        *MINIMAL_EXPORT_COLUMNS, "Quantity_Normalized", "UnitPrice_Standardized"
    )


def _described(path: str | Sequence[str] | None) -> list[str]:
    return [path] if isinstance(path, str) else list(path or [])


def _log(
    raw: DataFrame, work_path: str | None, inputs: str | Sequence[str] | None, regions: DataFrame | None = None, **settings: object
) -> RunLog:
    """The log of a run; with ``work_path`` it outlives the application and is found again by the same inputs."""
    spark = raw.sparkSession
    if work_path is None:
        return RunLog(spark)
    files = _described(inputs) or raw.inputFiles()
    if not files:
        raise ValueError("name the inputs of the raw lines, so that a later run can see whether they changed")
    more = [] if regions is None else regions.inputFiles()
    return RunLog(spark, work_path, fingerprint(spark, [*files, *more], regions=regions is not None, **settings))


def _clean_sales(log: RunLog, raw: DataFrame, clean: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """The stored sales of a run and how many lines were read and kept."""

    def make():
        lines, read = _counted(raw, "raw")
        cleaned, kept = _counted(clean(lines), "clean")
        return add_total_amount(cleaned), lambda: {"raw": read.get["rows"], "clean": kept.get["rows"]}

    return log.table("sales", make)


def run_full(
    raw: DataFrame,
    k: int = 5,
    export_path: str | None = None,
    monthly_sink: Callable[[DataFrame], None] | None = None,
    store_path: str | None = None,
    regions: DataFrame | None = None,
    work_path: str | None = None,
    inputs: str | Sequence[str] | None = None,
) -> RunResult:
    """The whole run; sinks that are not given are skipped. ``store_path`` is the folder of a ``SegmentStore``.

    With ``work_path`` a run that was killed goes on after its last whole stage if it is started again with the same
    settings while the files of ``inputs`` (by default those that ``raw`` names) and of ``regions`` are the same.
    """
    log = _log(raw, work_path, inputs, regions, run="full", k=k, sinks=[export_path, store_path, monthly_sink is not None])

    def clean(lines: DataFrame) -> DataFrame:
        return add_region(clean_modular(lines), regions)

    stored, rows = _clean_sales(log, raw, clean)
    sales = _featured(stored)

    def export() -> dict:
        export_csv(sales, export_path)
        return {}

    if export_path is not None:
        log.once("export", export)
    return _analyse(log, sales, k, monthly_sink, store_path, rows)


def run_basic(
    raw: DataFrame,
    k: int = 4,
    monthly_sink: Callable[[DataFrame], None] | None = None,
    store_path: str | None = None,
    work_path: str | None = None,
    inputs: str | Sequence[str] | None = None,
) -> RunResult:
    """Run without preprocessing exports: basic cleaning, trend, profiles, segments; restarted as ``run_full`` is.

    Countries are encoded here because the cluster features include the country index.
    """
    log = _log(raw, work_path, inputs, run="basic", k=k, sinks=[store_path, monthly_sink is not None])
    stored, rows = _clean_sales(log, raw, clean_basic)
    sales = encode_by_frequency(stored, "Country", "Country_Encoded")
    return _analyse(log, sales, k, monthly_sink, store_path, rows)


def _analyse(
    log: RunLog,
    sales: DataFrame,
    k: int,
    monthly_sink: Callable[[DataFrame], None] | None,
    store_path: str | None,
    rows: dict[str, int],
) -> RunResult:
    monthly = sales_monthly(sales)

    def send() -> dict:
        monthly_sink(monthly)
        return {}

    if monthly_sink is not None:
        log.once("monthly", send)

    def profile():
        observed, customers = _counted(compute_rfm(sales, extra_features=["Country_Encoded"]), "customers")
        return observed, lambda: {"customers": customers.get["rows"]}

    profiles, counted = log.table("profiles", profile)

    def cluster():
        run = rfm_kmeans(profiles, k)
        about = {"k": run.k, "silhouette": run.silhouette, "sse": run.sse, "centroids": [list(r) for r in run.centroids.collect()]}
        return run.assignments, lambda: about  # k centres

    assignments, about = log.table("clusters", cluster)
    schema = "cluster int, " + ", ".join(f"{f} double" for f in PROFILE_FEATURES)
    centroids = sales.sparkSession.createDataFrame([tuple(c) for c in about["centroids"]], schema)
    clusters = ClusterRun(assignments, centroids, about["k"], about["silhouette"], about["sse"])
    segments = segment_documents(label_clusters(assignments))
    if store_path is not None:
        store = SegmentStore(sales.sparkSession, store_path)
        stored = segments
        version = log.once("store", lambda: {"version": store.upsert(stored)})["version"]
        segments = store.read(version)
    return RunResult(sales, monthly, profiles, clusters, segments, {**rows, **counted}, log)
