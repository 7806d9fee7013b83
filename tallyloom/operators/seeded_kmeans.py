"""K-Means from k-means++ centres, many seeded runs at once, each pass one scan of a stored table.

A centre is drawn with a chance in proportion to the squared distance to the centres before it. The draw is a race: a row
finishes after an exponential time of that rate, whose chance comes from the row's own hash, the seed and
the number of the centre, and the first one wins. So the draws do not depend on how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.shipping import ship_package

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class SeededRun:
    seed: int
    centres: np.ndarray
    cost: float
    iterations: int


def chances(hashes: np.ndarray, seed: int, place: int) -> np.ndarray:
    """Numbers above 0 and below 1, one per row hash, that look random for each seed and place."""
    with np.errstate(over="ignore"):
        x = hashes.astype(np.uint64) ^ (np.uint64(seed) * _STEP + np.uint64(place + 1) * np.uint64(0xD1B54A32D192ED03))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def squared_gaps(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre."""
    gaps = np.zeros((len(points), len(centres)))
    for axis in range(points.shape[1]):  # few features; differences lose no digits, as expanded squares would
        gaps += np.subtract.outer(points[:, axis], centres[:, axis]) ** 2
    return gaps


def _points(batch: pa.RecordBatch, features: int) -> np.ndarray:
    return np.column_stack([batch.column(f"z{i}").to_numpy() for i in range(features)])


def _draw(rows: DataFrame, chosen: dict[int, np.ndarray], place: int, features: int) -> dict[int, list[float]]:
    """The next centre of each seed; none for a seed whose centres lie on all rows."""

    def race(batches: Iterator[pa.RecordBatch]):
        best: dict[int, tuple] = {}
        for batch in batches:
            points, hashes = _points(batch, features), batch.column("h").to_numpy()
            for seed, centres in chosen.items():
                weight = squared_gaps(points, centres).min(axis=1) if len(centres) else np.ones(len(points))
                (open_,) = np.nonzero(weight > 0)
                if len(open_):
                    times = -np.log(chances(hashes[open_], seed, place)) / weight[open_]
                    first = np.lexsort((hashes[open_], times))[0]
                    row = (float(times[first]), int(hashes[open_][first]), points[open_[first]].tolist())
                    best[seed] = min(best.get(seed, row), row)
        found = [{"seed": s, "time": t, "h": h, "z": z} for s, (t, h, z) in best.items()]
        yield pa.RecordBatch.from_pylist(found, pa.schema([("seed", pa.int64()), ("time", pa.float64()), ("h", pa.int64()), ("z", pa.list_(pa.float64()))]))

    raced = rows.mapInArrow(race, "seed long, time double, h long, z array<double>")
    winners = raced.groupBy("seed").agg(F.min_by("z", F.struct("time", "h")).alias("z"))
    return {row["seed"]: row["z"] for row in winners.collect()}  # one row per seed


def seeds_plus_plus(rows: DataFrame, k: int, seeds: Sequence[int], features: int) -> dict[int, np.ndarray]:
    """For each seed at most ``k`` centres, fewer if the rows have fewer different points."""
    chosen = {seed: np.zeros((0, features)) for seed in seeds}
    for place in range(k):
        for seed, z in _draw(rows, chosen, place, features).items():
            chosen[seed] = np.vstack((chosen[seed], z))
    return chosen


def _assigned(rows: DataFrame, centres: dict[int, np.ndarray], features: int) -> dict[tuple[int, int], tuple]:
    """(seed, cluster): its number of rows, their sums and their squared distances to the centre."""
    names = ["seed", "cluster", "n", "cost", *[f"s{i}" for i in range(features)]]

    def add(batches: Iterator[pa.RecordBatch]):
        totals = {seed: np.zeros((len(c), 2 + features)) for seed, c in centres.items()}
        for batch in batches:
            points = _points(batch, features)
            for seed, known in centres.items():
                gaps = squared_gaps(points, known)
                near = gaps.argmin(axis=1)
                figures = [np.ones(len(points)), gaps[np.arange(len(points)), near], *points.T]
                totals[seed] += np.column_stack([np.bincount(near, f, len(known)) for f in figures])
        labels = [(seed, c) for seed, t in totals.items() for c in range(len(t))]
        columns = [*zip(*labels, strict=True)], np.vstack(list(totals.values()))
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[0]), *map(pa.array, columns[1].T.copy())], names)

    schema = "seed long, cluster long, " + ", ".join(f"{n} double" for n in names[2:])
    summed = rows.mapInArrow(add, schema).groupBy("seed", "cluster").agg(*[F.sum(n).alias(n) for n in names[2:]])
    return {(r["seed"], r["cluster"]): tuple(r)[2:] for r in summed.collect()}  # k rows per seed


def best_runs(
    table: DataFrame,
    id_column: str,
    features: Sequence[str],
    k: int,
    seeds: Sequence[int],
    max_iter: int = 300,
    tol: float = 1e-4,
    watch: Callable[[int], None] | None = None,
) -> list[SeededRun]:
    """The runs of all seeds, the cheapest first.

    ``table`` should be stored; it is scanned once for each of ``k`` centres and once for each iteration, for all seeds
    together. A run ends when its centres together move by no more than ``tol`` (as a squared distance, in units of the
    features' mean variance) or after ``max_iter`` iterations. A cluster that loses all rows keeps its centre.
    """
    ship_package(table.sparkSession)
    columns = [F.col(f).cast("double").alias(f"z{i}") for i, f in enumerate(features)]
    rows = table.select(F.xxhash64(id_column).alias("h"), *columns).persist(StorageLevel.MEMORY_AND_DISK)
    size = len(columns)
    try:
        spread = rows.agg(*[F.coalesce(F.var_pop(f"z{i}"), F.lit(0.0)) for i in range(size)]).first()
        least = tol * float(np.mean(list(spread)))
        centres = {seed: c for seed, c in seeds_plus_plus(rows, k, list(seeds), size).items() if len(c)}
        moving, passed = dict(centres), dict.fromkeys(centres, 0)
        for number in range(max_iter):
            if not moving:
                break
            if watch is not None:
                watch(number)
            totals = _assigned(rows, moving, size)
            for seed, old in list(moving.items()):
                new = np.array([np.divide(t[2:], t[0]) if (t := totals[seed, c])[0] else old[c] for c in range(len(old))])
                centres[seed], passed[seed] = new, number + 1
                moving[seed] = new
                if ((new - old) ** 2).sum() <= least:
                    del moving[seed]
        costs = dict.fromkeys(centres, 0.0)
        for (seed, _), figures in (_assigned(rows, centres, size) if centres else {}).items():
            costs[seed] += figures[1]
    finally:
        rows.unpersist()
    return sorted((SeededRun(s, c, costs[s], passed[s]) for s, c in centres.items()), key=lambda r: (r.cost, r.seed))
