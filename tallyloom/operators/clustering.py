"""K-Means customer segmentation and measures of a labelling."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.shipping import ship_package
from tallyloom.functions.staging import stage
from tallyloom.operators import block_distances
from tallyloom.operators.features import z_score_scale
from tallyloom.operators.seeded_kmeans import best_runs

PROFILE_FEATURES = ("Recency", "Frequency", "Monetary", "Country_Encoded", "Sum_Qty")
RFM_FEATURES = ("Recency", "Frequency", "Monetary")
#: Rows of a block whose distances are taken, most blocks of all rows, and distances taken at once (0.5 MB).
SCORED_ROWS, MOST_BLOCKS, DISTANCES = 20_000, 256, 1 << 16


@dataclass(frozen=True)
class ClusterRun:
    """``assignments`` holds the input ids and features plus ``cluster``, 0 = highest Monetary centre."""

    assignments: DataFrame
    centroids: DataFrame
    k: int
    silhouette: float
    sse: float


def rfm_kmeans(
    profiles: DataFrame,
    k: int = 5,
    features: Sequence[str] = PROFILE_FEATURES,
    seed: int = 42,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> ClusterRun:
    """One k-means|| run on features standardised by the sample deviation. Null and blank ids are left out."""

    def fit(points: DataFrame, names: Sequence[str]) -> tuple[list, float]:
        vectors = VectorAssembler(inputCols=list(names), outputCol="features").transform(points).select("features")
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = KMeans(k=k, seed=seed, featuresCol="features", maxIter=max_iter, tol=tol).fit(vectors)
            return [c.tolist() for c in model.clusterCenters()], model.summary.trainingCost
        finally:
            vectors.unpersist()

    return _cluster(_feature_table(profiles, features), features, fit, population=False)


def kmeans_rfm3(
    profiles: DataFrame, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4
) -> ClusterRun:
    """Best of ``n_init`` runs by cost from k-means++ centres, on the three RFM features, standardised by the population
    deviation.

    ``k`` must lie between 2 and the smaller of 20 and the number of customers minus one.
    """
    table = _feature_table(profiles, RFM_FEATURES)
    most = min(20, table.count() - 1)
    if not 2 <= k <= most:
        raise ValueError(f"k must be between 2 and {most}")

    def fit(points: DataFrame, names: Sequence[str]) -> tuple[list, float]:
        best = best_runs(points, "CustomerID", names, k, range(seed, seed + n_init), max_iter, tol)[0]
        return best.centres.tolist(), best.cost

    return _cluster(table, RFM_FEATURES, fit, population=True)


def _feature_table(profiles: DataFrame, features: Sequence[str]) -> DataFrame:
    """The id and features of customers with all of them, stored in a layout fixed by the ids, so that iterations reread a
    narrow table and a rerun of the same input sees the same partitions."""
    # Lines without a customer share one blank id; they are no customer and would be a cluster of their own.
    profiles = profiles.filter(F.trim(F.col("CustomerID").cast("string")) != "")
    partitions = int(profiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(
        profiles.select("CustomerID", *[F.round(F.col(f).cast("double"), 6).alias(f) for f in features])
        .na.drop()
        .repartition(partitions, "CustomerID")
        .sortWithinPartitions("CustomerID"),
        "cluster-features",
    )


def _cluster(
    table: DataFrame, features: Sequence[str], fit: Callable[[DataFrame, Sequence[str]], tuple[list, float]], population: bool
) -> ClusterRun:
    """Label a table by the centres that ``fit`` finds on its standardised features."""
    deviation = F.stddev_pop if population else F.stddev_samp
    stats = table.agg(
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.coalesce(deviation(f), F.lit(0.0)).alias(f"std_{f}") for f in features],
    ).first()

    def standardised(f: str) -> Column:
        std = stats[f"std_{f}"]
        return ((F.col(f) - stats[f"mean_{f}"]) / std if std > 0 else F.lit(0.0)).alias(f"z_{f}")

    names = [f"z_{f}" for f in features]
    points = table.select("*", *[standardised(f) for f in features])
    centres, cost = fit(points, names)
    by_value = list(features).index("Monetary") if "Monetary" in features else 0
    centres = sorted(centres, key=lambda c: -c[by_value])
    gaps = [
        F.struct(sum(((F.col(z) - x) * (F.col(z) - x) for z, x in zip(names, c, strict=True)), F.lit(0.0)), F.lit(i).alias("i"))
        for i, c in enumerate(centres)
    ]
    nearest = (F.least(*gaps) if len(gaps) > 1 else gaps[0])["i"]
    labelled = points.withColumn("cluster", nearest)
    original_units = [
        (i, *[float(c[j]) * stats[f"std_{f}"] + stats[f"mean_{f}"] for j, f in enumerate(features)]) for i, c in enumerate(centres)
    ]
    schema = "cluster int, " + ", ".join(f"{f} double" for f in features)
    centroids = table.sparkSession.createDataFrame(original_units, schema)
    score = silhouette_of(labelled.select(F.col("cluster").alias("c"), *names), names).first()["score"]
    assignments = labelled.select("CustomerID", *features, "cluster")
    return ClusterRun(assignments, centroids, len(centres), float("nan") if score is None else score, cost)


def check_labels(run: ClusterRun, features: Sequence[str], population: bool) -> DataFrame:
    """``assignments`` plus the squared distance ``distance`` to the own centre on standardised features, and
    ``is_nearest``, whether no returned centre is nearer. Computed from the returned rows and centres alone."""
    deviation = F.stddev_pop if population else F.stddev_samp
    stats = run.assignments.agg(*[F.coalesce(deviation(f), F.lit(0.0)).alias(f) for f in features]).first()
    used = [f for f in features if stats[f] > 0]
    centres = {r["cluster"]: r for r in run.centroids.collect()}  # k rows
    gaps = [
        F.lit(float("inf")) if c not in centres else sum((((F.col(f) - centres[c][f]) / stats[f]) ** 2 for f in used), F.lit(0.0))
        for c in range(max(centres) + 1)
    ]
    rows = run.assignments.withColumn("gaps", F.array(*gaps)).withColumn("distance", F.get("gaps", F.col("cluster")))
    nearest = F.coalesce(F.col("distance") <= F.array_min("gaps") + 1e-9, F.lit(False))
    return rows.withColumn("is_nearest", nearest).drop("gaps")


def cluster_metrics(run: ClusterRun, features: Sequence[str] = RFM_FEATURES) -> DataFrame:
    """One row: k, silhouette (squared distances), SSE, Davies-Bouldin and Calinski-Harabasz."""
    scores = davies_bouldin(run.assignments, features).withColumnRenamed("score", "davies_bouldin")
    spread = calinski_harabasz(run.assignments, features).groupBy().agg(F.max("score")).scalar()
    return scores.select(
        F.lit(run.k).alias("k"),
        F.lit(float(run.silhouette)).alias("silhouette"),
        F.lit(float(run.sse)).alias("sse"),
        "davies_bouldin",
        spread.alias("calinski_harabasz"),
    )


def cluster_centroids(run: ClusterRun) -> DataFrame:
    """Cluster centres in the original units."""
    named = run.centroids.select(segment_name("cluster").alias("Segment"), *run.centroids.columns[1:])
    return named


def cluster_sizes(assignments: DataFrame, cluster: str = "cluster") -> DataFrame:
    return assignments.groupBy(segment_name(cluster).alias("Segment")).agg(
        F.count(F.lit(1)).alias("Customers")
    )


def segment_name(cluster: str = "cluster") -> Column:
    """``Segment-<id>`` for any id."""
    return F.concat(F.lit("Segment-"), F.col(cluster).cast("int").cast("string"))


def label_clusters(assignments: DataFrame, cluster: str = "cluster", known: int = 5) -> DataFrame:
    """Add ``segment_label``: ``Segment-<id>`` for ids below ``known``, else ``Segment-Other``."""
    named = F.when(F.col(cluster).between(0, known - 1), segment_name(cluster)).otherwise("Segment-Other")
    return assignments.withColumn("segment_label", named)


def _scaled(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    scaled = z_score_scale(df, {f: f"z_{f}" for f in features}, population=True)
    return scaled.select(F.col(cluster).alias("c"), *[f"z_{f}" for f in features])


def _least_other(stats: Column, gap: Callable[[Column], Column]) -> Column:
    return F.array_min(F.transform(F.filter(stats, lambda s: s["c"] != F.col("c")), gap))


def _mean_silhouette(rows: DataFrame) -> DataFrame:
    """The mean of (b - a) / max(a, b) over rows (a, b); a row whose ``a`` is unknown, being alone, counts as 0."""
    score = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    kept = rows.where(F.col("b").isNotNull())
    return kept.agg(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise(F.coalesce(score, F.lit(0.0)))).alias("score"))


def silhouette_of(points: DataFrame, features: Sequence[str]) -> DataFrame:
    """The silhouette of points (c, *features) by squared distances, one row ``score``; null with fewer than two clusters.

    The mean squared distance of a point to a cluster follows from the cluster's count, sums and sum of squares, so
    the points are read twice and never joined; the clusters' figures are one short list.
    """
    points = points.where(F.col("c").isNotNull())
    squares = sum((F.col(f) * F.col(f) for f in features), F.lit(0.0))
    per_cluster = points.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum(squares).alias("q"), *[F.sum(f).alias(f) for f in features])
    stats = per_cluster.agg(F.collect_list(F.struct("c", "n", "q", *features))).scalar()

    def gap(s: Column) -> Column:
        product = sum((F.col(f) * s[f] for f in features), F.lit(0.0))
        return F.greatest(squares + (s["q"] - 2 * product) / s["n"], F.lit(0.0))

    own = F.filter("stats", lambda s: s["c"] == F.col("c"))[0]
    a = F.when(own["n"] > 1, gap(own) * own["n"] / (own["n"] - 1))
    listed = points.withColumn("stats", stats)
    return _mean_silhouette(listed.select(a.alias("a"), _least_other(F.col("stats"), gap).alias("b")))


def silhouette(df: DataFrame, features: Sequence[str] = RFM_FEATURES, cluster: str = "cluster") -> DataFrame:
    """Silhouette of a labelling on standardised features, by squared distances; one row ``score``."""
    scored = silhouette_of(_scaled(df, features, cluster), [f"z_{f}" for f in features])
    return scored.select(F.round("score", 6).alias("score"))


def hash_share(column: str) -> Column:
    """A number from 0 to 1 that depends on the text of a column alone."""
    return F.conv(F.substring(F.md5(F.col(column).cast("string").cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32


def silhouette_euclidean(
    df: DataFrame,
    features: Sequence[str] = RFM_FEATURES,
    cluster: str = "cluster",
    id_column: str = "CustomerID",
    sample: int | None = None,
) -> DataFrame:
    """Silhouette of a labelling on standardised features, by plain distances; one row ``score``.

    Every row is scored by its distances to all others, so the work grows with the square of the rows.

    With ``sample`` the score is an estimate: a row's mean distance to a cluster is that to a sample of its members, those
    whose id in ``id_column`` has a ``hash_share`` below ``sample`` by the cluster's size. The sample reaches every task.
    """
    names = [f"z_{f}" for f in features]
    scaled = z_score_scale(df.where(F.col(cluster).isNotNull()), dict(zip(features, names, strict=True)), population=True)
    if sample is None:
        points = stage(scaled.select(F.col(cluster).alias("label"), F.monotonically_increasing_id().alias("r"), *names), "silhouette-points")
        numbers = stage(points.select("label").distinct().withColumn("c", F.monotonically_increasing_id()), "cluster-numbers")
        blocks = min(MOST_BLOCKS, max(1, math.ceil(points.count() / SCORED_ROWS)))
        dealt = points.join(numbers, "label").repartitionByRange(blocks, "c", "r").sortWithinPartitions("c", "r")
        return _mean_silhouette(_mean_distances(dealt, None, names)).select(F.round("score", 6).alias("score"))
    points = scaled.select(F.col(cluster).alias("c"), hash_share(id_column).alias("h"), *names)
    sizes = stage(points.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "cluster-sizes")
    marked = points.join(F.broadcast(sizes), "c").withColumn("sampled", F.col("h") < sample / F.col("n"))  # a row per cluster
    stored = stage(marked.where("sampled").select("c", *names), "silhouette-sample")
    # The stored segments may be one small file; their rows are dealt out, since each one meets the whole sample.
    rows = sizes.agg(F.sum("n")).first()[0] or 0
    dealt = marked.select("c", "sampled", *names).repartition(max(1, math.ceil(rows / SCORED_ROWS)))
    return _mean_silhouette(_mean_distances(dealt, stored, names)).select(F.round("score", 6).alias("score"))


def _mean_distances(points: DataFrame, sample: DataFrame | None, features: Sequence[str]) -> DataFrame:
    """(a, b) for each point: its mean distance to the points of its own cluster, itself left out, and the least one to those
    of another cluster. A distance to or from a null is null.

    Without a sample all points (c, *features) are meant, dealt by ranges of ``c``, a number. With one, only its
    points are, and each point is (c, sampled, *features).
    """
    if sample is None:
        return block_distances.mean_distances(points, features, DISTANCES)
    ship_package(points.sparkSession)
    # The sample, which the caller bounds, is sent to every task.
    held = sample.orderBy("c").toArrow()
    clusters, firsts = np.unique(held.column("c").to_numpy(), return_index=True)
    shared = points.sparkSession.sparkContext.broadcast((clusters, firsts, *block_distances.matrix(held, features)))

    def run(batches):
        clusters, firsts, others, unknown = shared.value
        many = np.diff(np.append(firsts, len(unknown)))
        lacking = np.add.reduceat(unknown, firsts) > 0 if len(clusters) else np.zeros(0, bool)
        step = max(1, DISTANCES // max(1, len(unknown)))
        for batch in batches:
            if not len(clusters):
                nothing = pa.nulls(batch.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays([nothing, nothing], ["a", "b"])
                continue
            mine, missing = block_distances.matrix(batch, features)
            labels = batch.column("c").to_numpy()
            # whether a row is in the sample is unknown, if it has no id
            sampled = batch.column("sampled").cast(pa.float64()).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, step):
                part = slice(at, at + step)
                squares = sum((np.subtract.outer(x, y) ** 2 for x, y in zip(mine[:, part], others, strict=True)), 0.0)
                totals = np.add.reduceat(np.sqrt(squares), firsts, axis=1)
                known = ~(missing[part, None] | lacking)
                own = clusters == labels[part, None]
                count = (own * many).sum(axis=1) - sampled[part]
                with np.errstate(all="ignore"):
                    a = np.where(own, totals, 0.0).sum(axis=1) / count
                    away = np.where(known & ~own, totals / many, np.nan)
                    b = np.fmin.reduce(away, axis=1)
                found_a = (count > 0) & (own & known).any(axis=1)
                found_b = (known & ~own).any(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a, mask=~found_a), pa.array(b, mask=~found_b)], ["a", "b"])

    return points.mapInArrow(run, "a double, b double")


def davies_bouldin(df: DataFrame, features: Sequence[str] = RFM_FEATURES, cluster: str = "cluster") -> DataFrame:
    """Davies-Bouldin index of a labelling on standardised features, one row ``score``.

    Each cluster is compared with every other one, as the index is defined; the comparisons are spread over tasks
    and only the worst of each cluster is kept.
    """
    z = [f"z_{f}" for f in features]
    points = _scaled(df, features, cluster)
    means = [F.avg(x).alias(f"m_{x}") for x in z]
    centres = stage(points.filter(F.col("c").isNotNull()).groupBy("c").agg(*means), "centres")

    def distance(xs: list[Column], ys: list[Column]) -> Column:
        return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(xs, ys, strict=True)), F.lit(0.0)))

    to_centre = distance([F.col(x) for x in z], [F.col(f"m_{x}") for x in z])
    spread = stage(points.join(centres, "c").groupBy("c", *[f"m_{x}" for x in z]).agg(F.avg(to_centre).alias("s")), "spreads")
    a, b = spread.alias("a"), spread.alias("b")
    gap = distance([F.col(f"a.m_{x}") for x in z], [F.col(f"b.m_{x}") for x in z])
    ratio = F.try_divide(F.col("a.s") + F.col("b.s"), gap)
    worst = a.join(b, F.col("a.c") != F.col("b.c")).groupBy("a.c").agg(F.max(ratio).alias("worst"))
    total = worst.agg(F.sum(F.coalesce("worst", F.lit(0.0))).alias("total"), F.count(F.lit(1)).alias("k"))
    return total.select(F.round(F.when(F.col("k") > 1, F.col("total") / F.col("k")), 6).alias("score"))


def calinski_harabasz(df: DataFrame, features: Sequence[str] = RFM_FEATURES, cluster: str = "cluster") -> DataFrame:
    """Calinski-Harabasz index of a labelling on standardised features, one row ``score``.

    Needs only counts, means and variances per cluster, so the rows are read once and never joined.
    """
    z = [f"z_{f}" for f in features]
    per_cluster = _scaled(df, features, cluster).groupBy("c").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"m_{x}") for x in z],
        *[F.var_pop(x).alias(f"v_{x}") for x in z],
    )
    # standardised features have mean 0, which is the common centre
    within = sum((F.col("n") * F.col(f"v_{x}") for x in z), F.lit(0.0))
    between = sum((F.col("n") * F.col(f"m_{x}") * F.col(f"m_{x}") for x in z), F.lit(0.0))
    totals = per_cluster.agg(
        F.sum(within).alias("w"),
        F.sum(between).alias("b"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
    )
    score = F.try_divide(
        F.try_divide(F.col("b"), F.col("k") - 1), F.try_divide(F.col("w"), F.col("n") - F.col("k"))
    )
    return totals.select(F.round(score, 6).alias("score"))
