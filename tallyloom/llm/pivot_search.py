"""Exact search for the vectors of highest inner product, with a table of distances to pivots.

For a pivot p, |d(q, p) - d(x, p)| is a lower bound of the distance of q and x, and the largest over all pivots bounds
their inner product from above: 2 q.x = |q|^2 + |x|^2 - d(q, x)^2. The rows that may matter are evaluated in the order
of that bound, until it falls to what the found ones reach.

Rows lie in groups, by nearest pivot. A query first meets its own group; its score at rank k then rules out whole
groups, by the ranges of their distances, and rows of the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.staging import stage
from tallyloom.llm.grouped import HELD, PASSING, by_group

#: Pivots, the rows they are chosen from (a bound on what the driver sees; it changes no result), and rows of a group.
PIVOTS, PIVOT_SAMPLE, GROUP_ROWS = 64, 2_000, 8_192
#: Rows evaluated first; every further step takes twice as many.
FIRST = 256
#: More than rounding can take off a bound, as a part of the norms; and the largest double that fits a long.
SLACK, LONGEST = 1e-9, 2.0**63 - 1024


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """The first vector and then always the one farthest from those chosen, while any lies apart."""
    chosen, apart = [0], np.full(len(sample), np.inf)
    while len(chosen) < count:
        apart = np.minimum(apart, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if not apart.max() > 0:
            break
        chosen.append(int(apart.argmax()))
    return sample[chosen]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of equal length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, x): components floor(scale * component), padded with zeros to the longest vector. Rows without an id and
    vectors that are null or hold null or non-finite components are left out; of rows that share an id the
    one with the smallest vector stays."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")) & ~F.isnan(c.cast("double")))
    usable = rows.where(F.col(vec_id).isNotNull() & F.coalesce(finite, F.lit(False)))
    one = usable.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))
    stored = stage(one, "vectors")
    size = F.coalesce(stored.agg(F.max(F.size("x"))).scalar(), F.lit(0))
    return stored.select("vec_id", F.concat("x", F.array_repeat(F.lit(0.0), size - F.size("x"))).alias("x"))


def _distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with their squared norms and their distances to the pivots."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)  # PIVOTS vectors

    def run(batches):
        known = shared.value
        own = (known**2).sum(axis=1)
        for batch in batches:
            x = _matrix(batch.column("x"))
            norm = (x**2).sum(axis=1)
            to = np.sqrt(np.maximum(norm[:, None] + own - 2 * (x @ known.T), 0))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(to.ravel()), len(known)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), pa.array(norm), lists], ["vec_id", "x", "norm", "to"])

    return rows.mapInArrow(run, "vec_id long, x array<double>, norm double, to array<double>")


def _grouped(table: DataFrame, total: int, pivots: int) -> DataFrame:
    """``table`` with ``group``: the rows nearest to a pivot, in as many parts as GROUP_ROWS asks for."""
    cells = max(1, min(pivots, -(-total // GROUP_ROWS)))
    near = F.slice("to", 1, cells)
    placed = stage(table.withColumn("cell", F.array_position(near, F.array_min(near)).cast("int")), "cells")
    counts = [(r["cell"], r["n"]) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect()]
    first, starts = 0, []
    for cell, n in counts:  # one row for each of at most PIVOTS cells
        parts = -(-n // GROUP_ROWS)
        starts.append((cell, first, parts))
        first += parts
    deal = placed.sparkSession.createDataFrame(starts, "cell int, first int, parts int")
    parted = placed.join(F.broadcast(deal), "cell")
    return parted.select(
        "vec_id", "x", "norm", "to", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")).alias("group")
    )


class Held:
    """The rows of a group: ids in order, vectors, squared norms, distances to the pivots."""

    def __init__(self, rows: pa.Table):
        self.ids, self.norms = rows.column("vec_id").to_numpy(), rows.column("norm").to_numpy()
        self.vectors = _matrix(rows.column("x"))
        self.most = float(np.abs(self.vectors).max(initial=0))
        self.short = self.vectors.astype(np.float32)
        self.table = np.ascontiguousarray(_matrix(rows.column("to")).astype(np.float32).T)  # a row for each pivot
        #: what rounding to 32 bits can add to a difference of distances
        self.error = 4 * float(np.spacing(self.table.max(initial=0)))

    def of(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and query in 32 bits if all inner products are exact in them, else in 64."""
        exact = self.most * max(float(np.abs(q).max(initial=0)), 1) * len(q) < 2**24
        return (self.short, q.astype(np.float32)) if exact else (self.vectors, q)

    def bounds(self, norm: float, to: np.ndarray) -> np.ndarray:
        """The largest whole inner product that each row can have with a query of this norm and these distances."""
        lower, gap = np.zeros(len(self.ids), np.float32), np.empty(len(self.ids), np.float32)
        for distances, own in zip(self.table, to.astype(np.float32), strict=True):
            np.abs(np.subtract(distances, own, out=gap), out=gap)
            np.maximum(lower, gap, out=lower)
        both = norm + self.norms
        return np.floor((both - np.maximum(lower.astype(np.float64) - self.error, 0) ** 2) / 2 + SLACK * (1 + both))

    def best(self, own: int, q: np.ndarray, norm: float, to: np.ndarray, floor: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the at most ``k`` best rows for a query, its own left out, that score ``floor`` or more."""
        bound = self.bounds(norm, to)
        (order,) = np.nonzero((bound >= floor) & (self.ids != own))
        below = bound.max(initial=-np.inf) - bound[order]
        below = below.astype(np.uint16) if below.max(initial=0) < 1 << 16 else below  # short numbers sort faster
        order = order[np.argsort(below, kind="stable")]  # equal bounds stay in the order of ids
        vectors, q = self.of(q)
        ids, scores = self.ids[:0], bound[:0]
        at, step = 0, FIRST
        while at < len(order):
            if len(ids) == k:
                ahead = order[at]  # no later row has a higher bound, or the same and a smaller id
                if (bound[ahead], -self.ids[ahead]) < (scores[-1], -ids[-1]):
                    break
                floor = scores[-1]
            rows = order[at : at + step]
            fresh = (vectors.take(rows, axis=0) @ q).astype(np.float64)
            good = fresh >= floor
            ids, scores = np.concatenate((ids, self.ids[rows[good]])), np.concatenate((scores, fresh[good]))
            keep = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[keep], scores[keep]
            at, step = at + step, step * 2
        return ids, scores


def _search(rows: DataFrame, tasks: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the best of each group for each query sent to it."""

    def work(held: pa.Table):
        group = Held(held)

        def answer(queries: pa.Table):
            vectors, tables = _matrix(queries.column("x")), _matrix(queries.column("to"))
            own, norms, floors = (queries.column(c).to_pylist() for c in ("vec_id", "norm", "floor"))
            found = [group.best(*row, k) for row in zip(own, vectors, norms, tables, floors, strict=True)]
            ids = np.repeat(np.array(own, np.int64), [len(i) for i, _ in found])
            scores = np.clip(np.concatenate([s for _, s in found]), -LONGEST, LONGEST).astype(np.int64)
            columns = [ids, np.concatenate([i for i, _ in found]), scores]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

        return answer

    return by_group(rows, tasks, work, "query_id long, vec_id long, score long", order=("vec_id",), most=2_000)


def _group_ranges(grouped: DataFrame, pivots: int) -> DataFrame:
    """(other, top, lo, hi): for each group its largest norm and its least and largest distance to each pivot."""
    ends = [F.array(*[f(F.col("to")[i]) for i in range(pivots)]).alias(name) for name, f in (("lo", F.min), ("hi", F.max))]
    return stage(grouped.groupBy(F.col("group").alias("other")).agg(F.max("norm").alias("top"), *ends), "groups")


def top_inner_products(
    rows: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64
) -> DataFrame:
    """For each query, a row whose id is divisible by ``every``, the ``k`` other rows (all, if fewer) of highest inner
    product of the vectors floor(scale * component): ``query_id``, ``rank`` (from 1; ties to the smaller id),
    ``vec_id`` and ``score``.

    Rows without an id, and vectors that are null or hold a null or non-finite component, take no part; a vector shorter
    than others counts as padded with zeros, an empty one as zero. Of rows that share an id the one with the smallest
    vector counts. Scores are exact below 2^53. Every row is searched, no cap is set; other columns are ignored.
    """
    vectors = integer_vectors(rows, vec_id, vector, scale)
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toArrow()
    if not len(sample):
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = choose_pivots(_matrix(sample.column("x")), PIVOTS)
    grouped = stage(_grouped(_distances(vectors, pivots), vectors.count(), len(pivots)), "pivot-table")
    groups = _group_ranges(grouped, len(pivots))
    tasks = groups.count()

    points = grouped.select("*", F.lit(HELD).alias("kind"), F.lit(float("-inf")).alias("floor"))
    queries = grouped.where(F.col("vec_id") % every == 0).withColumn("kind", F.lit(PASSING))
    near = stage(_search(points.unionByName(queries.withColumn("floor", F.lit(float("-inf")))), tasks, k), "own-group")
    reached = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") == k, F.col("least").cast("double")).otherwise(float("-inf"))
    asked = queries.join(reached, "vec_id", "left").withColumn("floor", floor)
    # A stated query set against the groups: only those whose ranges allow the score reached so far.
    lower = "array_max(transform(to, (d, i) -> greatest(d - hi[i], lo[i] - d, 0D)))"
    bound = f"(norm + top - pow({lower}, 2)) / 2 + {SLACK} * (1 + norm + top)"
    sent = asked.join(groups, F.expr(f"group <> other and {bound} >= floor"))
    passing = sent.select("vec_id", "x", "norm", "to", F.col("other").alias("group"), "kind", "floor")
    far = _search(points.unionByName(passing), tasks, k)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = near.unionByName(far).withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
