import math
import random

import numpy as np
import pytest

from frames import *  # noqa: F403
from tallyloom.llm import pivot_search

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=20, every=20):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            whole = [float(math.floor(64 * np.float64(np.float32(c)))) for c in v]
            kept[i] = min(kept.get(i, whole), whole)
    out = []
    for q in kept:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(kept[q], v)), i) for i, v in kept.items() if i != q)  # noqa: B905
            out += [(q, rank + 1, i, int(-s)) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = pivot_search.top_inner_products(frame, **options)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(pivot_search, "GROUP_ROWS", 40)
    monkeypatch.setattr(pivot_search, "FIRST", 8)


def test_clusters_ties_and_copies_in_many_groups(spark, small_groups):
    random.seed(5)
    centres = [[random.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [c + random.gauss(0, 0.1) for c in random.choice(centres)]) for i in range(-30, 400)]
    rows += [(1000 + i, centres[0]) for i in range(200)]  # a third of the rows are copies, and tie
    random.shuffle(rows)
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows, k=3, every=50) == brute(rows, 3, 50)


def test_odd_vectors(spark, small_groups):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0]), (40, []), (60, None), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0])]
    rows += [(None, [1.0, 1.0]), (None, None), (3, [0.5, -0.01]), (3, [0.5, -0.01]), (5, [9.0]), (5, [-9.0]), (7, [0.0, 0.0])]
    rows += [(140, [1e6, -1e6])]
    assert search(spark, rows) == brute(rows)
    assert search(spark, []) == [] and search(spark, [(1, None)]) == [] and search(spark, [(20, [1.0])]) == []
    assert search(spark, [(i, []) for i in range(0, 60, 7)]) == brute([(i, []) for i in range(0, 60, 7)])
    assert search(spark, [(i, [0.0] * 3) for i in range(90)]) == brute([(i, [0.0] * 3) for i in range(90)])


def test_clashing_columns(spark):
    frame = spark.range(0, 50).selectExpr(
        "id as vec_id", "array(cast(id as float), 1f) as embedding", "'x' as x", "'x' as norm", "'x' as to", "'x' as `group`",
        "'x' as kind", "'x' as floor", "'x' as cell", "'x' as first", "'x' as parts", "'x' as rank", "'x' as score", "'x' as other",
    )
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert sorted(tuple(r) for r in pivot_search.top_inner_products(frame).collect()) == brute(rows)


def test_elimination_leaves_most_rows_of_far_clusters_alone():
    random.seed(8)
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 40, (20, 16)).round()
    x = np.repeat(centres, 200, axis=0) + rng.integers(-1, 2, (4000, 16))
    pivots = pivot_search.choose_pivots(x[::7], 32)
    to = np.sqrt(((x[:, None] - pivots) ** 2).sum(-1))
    import pyarrow as pa

    norms = (x**2).sum(axis=1)
    held = pivot_search.Held(pa.table({"vec_id": np.arange(4000), "x": x.tolist(), "norm": norms, "to": to.tolist()}))
    evaluated = []

    class Counted(np.ndarray):
        def take(self, rows, axis):
            evaluated.append(len(rows))
            return np.asarray(self).take(rows, axis)

    held.short, held.vectors = held.short.view(Counted), held.vectors.view(Counted)
    for q in (0, 777, 3999):
        ids, scores = held.best(q, x[q], norms[q], to[q], -math.inf, 20)
        order = sorted((-float(x[q] @ x[i]), i) for i in range(4000) if i != q)[:20]
        assert [(-s, i) for s, i in zip(scores, ids)] == order  # noqa: B905
    assert sum(evaluated) < 0.5 * 3 * 4000
