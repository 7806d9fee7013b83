import dataclasses

import numpy as np
import pytest
from conftest import as_dict

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler

from tallyloom.operators import clustering, seeded_kmeans, segments

FEATURES = list(clustering.RFM_FEATURES)


@pytest.fixture(scope="module")
def points():
    random = np.random.default_rng(11)
    centres = np.array([[5.0, 40.0, 9000.0], [200.0, 3.0, 300.0], [60.0, 12.0, 2500.0]])
    spread = np.array([4.0, 2.0, 200.0])
    x = np.vstack([c + random.normal(size=(60, 3)) * spread for c in centres])
    return x, np.repeat(np.arange(3), 60)


@pytest.fixture(scope="module")
def profiles(spark, points):
    x, labels = points
    rows = [(f"c{i}", *map(float, row), int(label)) for i, (row, label) in enumerate(zip(x, labels, strict=True))]
    schema = "CustomerID string, Recency double, Frequency double, Monetary double, label int"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def run(profiles):
    return clustering.kmeans_rfm3(profiles, 3, n_init=4)


def test_assignments_are_the_nearest_centres(run, profiles):
    rows = run.assignments.collect()
    assert sorted(r["CustomerID"] for r in rows) == sorted(r["CustomerID"] for r in profiles.collect())
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    centres = np.array([[r[f] for f in FEATURES] for r in run.centroids.orderBy("cluster").collect()])
    zc = (centres - x.mean(axis=0)) / x.std(axis=0)
    distance = ((z[:, None, :] - zc[None, :, :]) ** 2).sum(axis=2)
    assert (distance.argmin(axis=1) == [r["cluster"] for r in rows]).all()
    assert run.sse == pytest.approx(distance.min(axis=1).sum(), rel=1e-6)
    assert 0.5 < run.silhouette <= 1.0 and run.k == 3


def test_true_groups_are_found_and_numbered_by_value(run, points):
    truth = {f"c{i}": label for i, label in enumerate(points[1])}
    found = as_dict(run.assignments, "CustomerID", "cluster")
    renamed = {0: 0, 2: 1, 1: 2}  # groups by descending Monetary
    assert all(found[c] == renamed[label] for c, label in truth.items())
    assert as_dict(clustering.cluster_sizes(run.assignments), "Segment", "Customers") == {
        "Segment-0": 60,
        "Segment-1": 60,
        "Segment-2": 60,
    }
    monetary = [r["Monetary"] for r in clustering.cluster_centroids(run).orderBy("Segment").collect()]
    assert monetary == sorted(monetary, reverse=True)


def test_layout_of_the_input_does_not_matter(profiles, run):
    again = clustering.kmeans_rfm3(profiles.coalesce(1), 3, n_init=4)
    assert as_dict(again.assignments, "CustomerID", "cluster") == as_dict(run.assignments, "CustomerID", "cluster")


def test_more_clusters_cost_less(profiles):
    costs = [clustering.kmeans_rfm3(profiles, k, n_init=3).sse for k in (2, 3, 6)]
    assert costs == sorted(costs, reverse=True)


def test_k_is_checked(profiles):
    for k in (1, 21):
        with pytest.raises(ValueError):
            clustering.kmeans_rfm3(profiles, k)
    with pytest.raises(ValueError):
        clustering.kmeans_rfm3(profiles.limit(3), 3)


def test_single_run_drops_incomplete_rows_and_keeps_a_constant_feature(spark, profiles):
    more = profiles.selectExpr("*", "1.0D as Country_Encoded", "Frequency * 3 as Sum_Qty")
    broken = more.limit(1).selectExpr(
        "'x' as CustomerID", "cast(null as double) as Recency", "Frequency", "Monetary", "label",
        "Country_Encoded", "Sum_Qty",
    )
    result = clustering.rfm_kmeans(more.unionByName(broken), 3)
    assert result.assignments.count() == 180
    assert result.assignments.columns == ["CustomerID", *clustering.PROFILE_FEATURES, "cluster"]


def _scores(x, labels):
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    groups = [z[labels == k] for k in np.unique(labels)]
    centres = [g.mean(axis=0) for g in groups]
    spread = [np.linalg.norm(g - c, axis=1).mean() for g, c in zip(groups, centres, strict=True)]
    k, n = len(groups), len(z)
    davies = np.mean(
        [
            max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(k) if j != i)
            for i in range(k)
        ]
    )
    within = sum(((g - c) ** 2).sum() for g, c in zip(groups, centres, strict=True))
    between = sum(len(g) * (c**2).sum() for g, c in zip(groups, centres, strict=True))
    return davies, (between / (k - 1)) / (within / (n - k))


def test_indices_of_a_labelling(profiles, points):
    davies, calinski = _scores(*points)
    assert clustering.davies_bouldin(profiles, cluster="label").first()["score"] == pytest.approx(davies, abs=1e-5)
    assert clustering.calinski_harabasz(profiles, cluster="label").first()["score"] == pytest.approx(calinski, rel=1e-6)
    one = profiles.selectExpr("*", "1 as same")
    assert clustering.davies_bouldin(one, cluster="same").first()["score"] is None
    assert clustering.calinski_harabasz(one, cluster="same").first()["score"] is None


def _silhouette(z, labels, distance):
    scores = []
    for i in range(len(z)):
        mean = {c: distance(z[i] - z[labels == c]).sum() for c in set(labels)}
        size = {c: (labels == c).sum() for c in mean}
        own = labels[i]
        if size[own] == 1:
            scores.append(0.0)
            continue
        a = mean[own] / (size[own] - 1)
        b = min(mean[c] / size[c] for c in mean if c != own)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.mean(scores)


def test_silhouettes_against_all_pairs(spark, profiles, points):
    x, labels = points
    labels = labels.copy()
    labels[:20] = 1  # some are badly placed
    labels[5] = 7  # and one is alone
    rows = [(f"c{i}", *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, labels, strict=True))]
    df = spark.createDataFrame(rows, "CustomerID string, Recency double, Frequency double, Monetary double, label int")
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    squared = _silhouette(z, labels, lambda d: (d**2).sum(axis=1))
    plain = _silhouette(z, labels, lambda d: np.sqrt((d**2).sum(axis=1)))
    assert clustering.silhouette(df, cluster="label").first()["score"] == pytest.approx(squared, abs=1e-6)
    assert clustering.silhouette_euclidean(df, cluster="label").first()["score"] == pytest.approx(plain, abs=1e-6)
    sampled = clustering.silhouette_euclidean(df, cluster="label", sample=25).first()["score"]
    assert sampled == pytest.approx(plain, abs=0.05) and sampled != pytest.approx(plain, abs=1e-6)
    again = clustering.silhouette_euclidean(df.repartition(7), cluster="label", sample=25).first()["score"]
    assert again == pytest.approx(sampled, abs=1e-6)
    one = df.selectExpr("*", "1 as same", "cast(null as int) as none")
    for wanted in ("same", "none"):
        assert clustering.silhouette(one, cluster=wanted).first()["score"] is None
        assert clustering.silhouette_euclidean(one, cluster=wanted).first()["score"] is None


def test_the_silhouette_of_a_run_is_that_of_the_library(profiles, run):
    scale = profiles.selectExpr(*[f"avg({f})" for f in FEATURES], *[f"stddev_pop({f})" for f in FEATURES]).first()
    names = [f"z{i}" for i in range(3)]
    z = run.assignments.selectExpr("cluster", *[f"({f} - {scale[i]!r}D) / {scale[i + 3]!r}D as z{i}" for i, f in enumerate(FEATURES)])
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(z)
    library = ClusteringEvaluator(predictionCol="cluster").evaluate(vectors)
    assert run.silhouette == pytest.approx(library, abs=1e-9)


def _plus_plus(points, hashes, k, seed):
    """The draws of one seed, worked out in memory."""
    centres = []
    for place in range(k):
        weight = np.ones(len(points)) if not centres else np.min([((points - c) ** 2).sum(axis=1) for c in centres], axis=0)
        if not weight.any():
            break
        with np.errstate(divide="ignore"):
            times = -np.log(seeded_kmeans.chances(hashes, seed, place)) / weight
        centres.append(points[np.argmin(times)])
    return np.array(centres)


def test_seeds_do_not_depend_on_the_layout(spark, profiles, points):
    table = profiles.selectExpr("xxhash64(CustomerID) as h", "Recency as z0", "Frequency as z1", "Monetary as z2")
    rows = table.collect()
    x, h = np.array([tuple(r)[1:] for r in rows]), np.array([r["h"] for r in rows])
    expected = {seed: _plus_plus(x, h, 5, seed) for seed in range(4)}
    for frame in (table, table.coalesce(1), table.repartition(9).sortWithinPartitions("z1")):
        found = seeded_kmeans.seeds_plus_plus(frame, 5, range(4), 3)
        assert all((found[seed] == expected[seed]).all() for seed in range(4))
    assert len({expected[seed].tobytes() for seed in range(4)}) == 4


def test_far_points_are_drawn_in_proportion_to_their_squared_distance():
    x = np.array([[0.0], [1.0], [3.0]])
    drawn = {1.0: 0, 3.0: 0}
    for seed in range(6000):
        weight, h = (x[:, 0]) ** 2, np.arange(3)
        with np.errstate(divide="ignore"):
            first = np.argmin(-np.log(seeded_kmeans.chances(h, seed, 1)) / weight)
        drawn[float(x[first, 0])] += 1
    assert drawn[3.0] / 6000 == pytest.approx(0.9, abs=0.015)


def test_the_cheapest_of_ten_runs_is_kept(spark):
    random = np.random.default_rng(3)
    x = np.vstack([random.normal(size=(40, 2)) + c for c in ([0, 0], [0, 9], [9, 0], [9, 9], [30, 30])])
    df = spark.createDataFrame([(f"c{i}", *map(float, r)) for i, r in enumerate(x)], "id string, a double, b double")
    runs = seeded_kmeans.best_runs(df, "id", ["a", "b"], 5, range(10))
    assert len(runs) == 10 and [r.cost for r in runs] == sorted(r.cost for r in runs)
    for run in runs:
        gaps = ((x[:, None] - run.centres) ** 2).sum(axis=2)
        assert run.cost == pytest.approx(gaps.min(axis=1).sum())
        means = np.array([x[gaps.argmin(axis=1) == c].mean(axis=0) for c in range(5)])
        assert np.abs(means - run.centres).max() < 0.2
    assert runs[0].cost < 2 * 200 * 1.5  # each group has its own centre
    copies = spark.createDataFrame([(str(i), float(i % 2), 0.0) for i in range(20)], "id string, a double, b double")
    few = seeded_kmeans.best_runs(copies, "id", ["a", "b"], 4, [1, 2])
    assert [len(r.centres) for r in few] == [2, 2] and [r.cost for r in few] == [0.0, 0.0]


def test_metrics_row(run):
    row = clustering.cluster_metrics(run).first()
    assert row["k"] == 3 and row["sse"] == run.sse and row["davies_bouldin"] < 1 < row["calinski_harabasz"]


def test_many_clusters_have_an_index(spark):
    random = np.random.default_rng(5)
    labels = np.repeat(np.arange(1500), 2)
    x = random.normal(size=(3000, 3)) * 50
    rows = [(*map(float, row), int(label)) for row, label in zip(x, labels, strict=True)]
    df = spark.createDataFrame(rows, "Recency double, Frequency double, Monetary double, label int")
    score = clustering.davies_bouldin(df, cluster="label").first()["score"]
    assert score == pytest.approx(_scores(x, labels)[0], rel=1e-5)


def test_wrong_labels_are_seen(run):
    good = clustering.check_labels(run, FEATURES, population=True)
    assert good.count() == 180 and good.filter("not is_nearest").count() == 0
    broken = run.assignments.selectExpr("CustomerID", *FEATURES, "if(CustomerID = 'c3', (cluster + 1) % 3, cluster) cluster")
    wrong = clustering.check_labels(dataclasses.replace(run, assignments=broken), FEATURES, population=True)
    assert [r["CustomerID"] for r in wrong.filter("not is_nearest").collect()] == ["c3"]


def test_blank_ids_are_no_customers(spark, profiles):
    blank = profiles.limit(2).selectExpr("if(label = 0, '  ', '') CustomerID", "Recency", "Frequency", "1e9D Monetary", "label")
    result = clustering.kmeans_rfm3(profiles.unionByName(blank), 3, n_init=2)
    assert result.assignments.count() == 180


def test_labels(spark):
    df = spark.createDataFrame([(0,), (4,), (5,), (None,)], "cluster int")
    named = as_dict(clustering.label_clusters(df), "cluster", "segment_label")
    assert named == {0: "Segment-0", 4: "Segment-4", 5: "Segment-Other", None: "Segment-Other"}
    assert df.select(clustering.segment_name().alias("s")).collect()[2]["s"] == "Segment-5"


def test_box_statistics(spark):
    values = [1.0, 2.0, 2.4, 3.0, 4.0, 100.0]
    rows = [("a", v) for v in values] + [("b", 7.0), ("b", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "Segment string, Monetary double")
    got = {r["Segment"]: tuple(r)[1:] for r in segments.segment_box_stats(df).collect()}
    q1, median, q3 = (round(float(q), 2) for q in np.quantile(values, [0.25, 0.5, 0.75]))
    assert got == {"a": (q1, median, q3, 1.0, 4.0, 1), "b": (7.0, 7.0, 7.0, 7.0, 7.0, 0)}


def test_cancellations_by_segment(spark, raw):
    labels = spark.createDataFrame([("17850", "gold"), ("17851", "tin")], "CustomerID string, Segment string")
    got = [tuple(r) for r in segments.cancellations_by_segment(raw, labels).collect()]
    assert got == [("gold", 2)]


def test_distances_to_a_sample_are_dealt_out_and_keep_nulls(spark, monkeypatch):
    rows = [(i % 3, float(i), float(i * i % 7), str(i)) for i in range(60)] + [(1, None, 2.0, "x")]
    df = spark.createDataFrame(rows, "label int, p double, q double, CustomerID string").coalesce(1)
    monkeypatch.setattr(clustering, "SCORED_ROWS", 10)
    monkeypatch.setattr(clustering, "DISTANCES", 50)
    seen = []
    real = clustering._mean_distances

    def watched(points, sample, features):
        seen.append(points.rdd.getNumPartitions())
        found = real(points, sample, features)
        seen.append([tuple(r) for r in found.collect()])
        return found

    monkeypatch.setattr(clustering, "_mean_distances", watched)
    score = clustering.silhouette_euclidean(df, ["p", "q"], cluster="label").first()["score"]
    known = [r for r in rows if r[1] is not None]
    p, q = np.array([r[1] for r in known]), np.array([r[2] for r in rows])
    x = np.array([[(r[1] - p.mean()) / p.std(), (r[2] - q.mean()) / q.std()] for r in known])
    gaps, of = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), np.array([r[0] for r in known])
    scores = []
    for i, c in enumerate(of):
        # cluster 1 holds a null, so no mean distance to it is known: its rows count as 0
        a = None if c == 1 else gaps[i, of == c].sum() / ((of == c).sum() - 1)
        b = min(gaps[i, of == d].mean() for d in {0, 2} - {c})
        scores.append(0.0 if a is None else (b - a) / max(a, b))
    assert seen[0] == 7 and len(seen[1]) == 61 and seen[1].count((None, None)) == 1
    assert score == pytest.approx(np.mean(scores), abs=1e-6)


def test_every_row_meets_every_other_one_in_blocks(spark, monkeypatch):
    random = np.random.default_rng(17)
    # two clusters of more than 1,000 rows over several blocks, many within one block, and one row alone
    labels = np.concatenate([np.zeros(1300, int), np.repeat(np.arange(1, 60), 5), np.full(1205, 60), [99]])
    x = np.vstack([random.normal(size=(len(labels) - 200, 3)) ** 3 + labels[200:, None] % 7, np.ones((200, 3))])
    rows = [(f"c{i}", *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, labels, strict=True))]
    schema = "CustomerID string, Recency double, Frequency double, Monetary double, label int"
    df = spark.createDataFrame(rows, schema).repartition(5)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    expected = _silhouette(z, labels, lambda d: np.sqrt((d**2).sum(axis=1)))
    assert clustering.silhouette_euclidean(df, cluster="label").first()["score"] == pytest.approx(expected, abs=1.1e-6)
    monkeypatch.setattr(clustering, "SCORED_ROWS", 250)
    monkeypatch.setattr(clustering, "DISTANCES", 1000)
    assert clustering.silhouette_euclidean(df, cluster="label").first()["score"] == pytest.approx(expected, abs=1.1e-6)
    monkeypatch.setattr(clustering, "MOST_BLOCKS", 4)
    named = df.drop("CustomerID").selectExpr("*", "concat('l', label) as name")
    assert clustering.silhouette_euclidean(named, cluster="name").first()["score"] == pytest.approx(expected, abs=1.1e-6)


def test_a_null_between_blocks_makes_the_means_to_its_cluster_unknown(spark, monkeypatch):
    monkeypatch.setattr(clustering, "SCORED_ROWS", 4)
    rows = [(c, float(i * c % 5), float(i)) for c in range(4) for i in range(7)] + [(1, None, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "label int, p double, q double")
    known = [r for r in rows if r[0] is not None]
    p, q = np.array([r[1] for r in known if r[1] is not None]), np.array([r[2] for r in known])
    x = {r: ((r[1] - p.mean()) / p.std(), (r[2] - q.mean()) / q.std()) for r in known if r[1] is not None}
    gap = lambda r, s: np.hypot(x[r][0] - x[s][0], x[r][1] - x[s][1])
    scores = []
    for r in x:
        mean = {c: np.sum([gap(r, s) for s in x if s[0] == c]) / (6 if c == r[0] else 7) for c in (0, 2, 3)}
        a, b = mean.get(r[0]), min(m for c, m in mean.items() if c != r[0])
        scores.append(0.0 if a is None else (b - a) / max(a, b))
    assert clustering.silhouette_euclidean(df, ["p", "q"], cluster="label").first()["score"] == pytest.approx(np.mean(scores), abs=1e-6)
