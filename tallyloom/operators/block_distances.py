"""Mean distances of every row to the members of each cluster, by blocks of rows that meet two at a time.

Every two rows are compared, so the work grows with the square of the rows. It is dealt out over the pairs of blocks; a task
holds a few blocks, and neither it nor the driver holds the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.shipping import ship_package
from tallyloom.functions.staging import stage

_PACKED = "block int, labels binary, unknown binary, z binary"
_MET = "target int, c long, n long, totals binary, labels binary, near binary"


@dataclass(frozen=True)
class Block:
    """Rows sorted by label: the points as (feature, row), and whether a feature of the row is null."""

    labels: np.ndarray
    unknown: np.ndarray
    points: np.ndarray

    def __post_init__(self) -> None:
        starts = np.flatnonzero(np.diff(self.labels, prepend=self.labels[0] - 1))
        object.__setattr__(self, "starts", starts)
        object.__setattr__(self, "sizes", np.diff(np.append(starts, len(self.labels))))


def matrix(table: pa.Table | pa.RecordBatch, features: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The features as (feature, row), 0 for a null, and whether a row has a null."""
    columns = [table.column(f) for f in features]
    unknown = np.zeros(table.num_rows, bool)
    for column in columns:
        unknown |= np.asarray(column.is_null())
    values = [column.fill_null(0.0).to_numpy() for column in columns]
    return np.array(values, np.float64).reshape(len(features), table.num_rows), unknown


def _between(one: Block, part: slice, other: Block, room: np.ndarray) -> np.ndarray:
    """Distances of some rows of a block to all of another, in ``room``; one to or from an unknown point is infinite."""
    gaps, spare = room[:, : part.stop - part.start]
    for f, (x, y) in enumerate(zip(one.points[:, part], other.points, strict=True)):
        into = spare if f else gaps
        np.subtract.outer(x, y, out=into)
        np.multiply(into, into, out=into)
        if f:
            np.add(gaps, spare, out=gaps)
    np.sqrt(gaps, out=gaps)
    gaps[one.unknown[part]] = np.inf
    if other.unknown.any():
        gaps[:, other.unknown] = np.inf
    return gaps


def meet(one: Block, other: Block, distances: int) -> Iterator[tuple[bool, int | None, int, np.ndarray, np.ndarray | None]]:
    """What the rows of two blocks find in each other: (whether ``other`` is the finder, cluster, its members, totals, near).

    ``totals`` are sums of distances to the first and last cluster of the block that is found, as other blocks may
    hold more of their members. All clusters between lie in that block alone: without a cluster, ``totals`` are the least
    mean distances to them, own ones left out, and ``near`` the mean distances to other members of the own one.
    """
    same, rows, many, last = one is other, len(one.labels), len(other.labels), len(other.starts) - 1
    first_totals, last_totals = np.empty(rows), np.empty(rows)
    least, near = np.full(rows, np.inf), np.full(rows, np.inf)
    back: dict[int, np.ndarray] = {}
    back_least = np.full(many, np.inf)
    step = max(1, min(distances // many, rows))
    room = np.empty((2, step, many))
    for s, (start, size) in enumerate(zip(one.starts, one.sizes, strict=True)):
        columns = np.zeros(many)
        for at in range(start, start + size, step):
            part = slice(at, min(at + step, start + size))
            gaps = _between(one, part, other, room)
            totals = np.add.reduceat(gaps, other.starts, axis=1)
            first_totals[part], last_totals[part] = totals[:, 0], totals[:, -1]
            if last > 1:
                means = totals[:, 1:-1] / other.sizes[1:-1]
                if same and 0 < s < last:
                    means[:, s - 1] = np.inf
                    if size > 1:
                        near[part] = totals[:, s] / (size - 1)
                least[part] = means.min(axis=1)
            if not same:
                columns += gaps.sum(axis=0)
        if s in (0, len(one.starts) - 1):
            back[s] = columns
        else:
            back_least = np.minimum(back_least, columns / size)
    yield False, int(other.labels[0]), int(other.sizes[0]), first_totals, None
    if last:
        yield False, int(other.labels[-1]), int(other.sizes[-1]), last_totals, None
    if same:
        yield False, None, 0, least, near
        return
    if last > 1:
        yield False, None, 0, least, None
    for s, columns in back.items():
        yield True, int(one.labels[one.starts[s]]), int(one.sizes[s]), columns, None
    if len(one.starts) > 2:
        yield True, None, 0, back_least, None


def _packed(points: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row for each partition of points (c, *features) that has rows."""

    def pack(batches: Iterator[pa.RecordBatch]):
        held = [batch for batch in batches if batch.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            values, unknown = matrix(table, features)
            row = [table.column("block")[0].as_py(), table.column("c").to_numpy().tobytes(), unknown.tobytes(), values.tobytes()]
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "labels", "unknown", "z"])

    return points.select(F.spark_partition_id().alias("block"), "c", *features).mapInArrow(pack, _PACKED)


def mean_distances(points: DataFrame, features: Sequence[str], distances: int) -> DataFrame:
    """(a, b) for each point (c, *features): its mean distance to the other points of its own cluster, and the least one to
    those of another cluster. A distance to or from a null is null, and so is a mean over it.

    ``c`` is a number. The partitions of ``points`` are its blocks: they are sorted by ``c`` and follow each other in its order,
    so a cluster that is neither the first nor the last of its block has all members there. ``distances`` are taken
    at once. Each two blocks meet in one task, which gives both what they find in the other.
    """
    ship_package(points.sparkSession)
    width = len(features)
    blocks = stage(_packed(points, features), "distance-blocks")
    ids = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    others = blocks.withColumnsRenamed({c: f"other_{c}" for c in blocks.columns})
    # Each two blocks meet once, and every block meets about half of the others as the first of the two.
    ahead = F.pmod(F.col("other_block") - F.col("block"), F.lit(ids)) * 2
    once = (ahead < ids) | ((ahead == ids) & (F.col("block") < F.col("other_block")))
    pairs = blocks.join(others.hint("shuffle_replicate_nl"), once)

    def read(row: dict, prefix: str) -> Block:
        labels = np.frombuffer(row[f"{prefix}labels"], np.int64)
        unknown = np.frombuffer(row[f"{prefix}unknown"], bool)
        return Block(labels, unknown, np.frombuffer(row[f"{prefix}z"], np.float64).reshape(width, len(labels)))

    def compare(batches: Iterator[pa.RecordBatch]):
        schema = pa.schema([("target", pa.int32()), ("c", pa.int64()), ("n", pa.int64()), *((f, pa.binary()) for f in ("totals", "labels", "near"))])
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                one = read(row, "")
                same = row["block"] == row["other_block"]
                other = one if same else read(row, "other_")
                found = []
                for back, c, n, totals, near in meet(one, other, distances):
                    own = near is not None
                    found.append(
                        {
                            "target": row["other_block"] if back else row["block"],
                            "c": c,
                            "n": n,
                            "totals": totals.tobytes(),
                            "labels": row["labels"] if own else None,
                            "near": near.tobytes() if own else None,
                        }
                    )
                yield pa.RecordBatch.from_pylist(found, schema)

    met = pairs.mapInArrow(compare, _MET)
    # A null sorts first: the labels of a block come before the sums that need them.
    gathered = met.repartition(ids, "target").sortWithinPartitions("target", F.col("c").asc_nulls_first())

    def add_up(batches: Iterator[pa.RecordBatch]):
        block = None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                totals = np.frombuffer(row["totals"], np.float64)
                if block is None or row["target"] != block.target:
                    if block is not None:
                        yield block.result()
                    block = _Sums(row["target"], len(totals))
                block.add(row["c"], row["n"], totals, row["labels"], row["near"])
        if block is not None:
            yield block.result()

    return gathered.mapInArrow(add_up, "a double, b double")


class _Sums:
    """The mean distances of a block's rows, added up cluster by cluster."""

    def __init__(self, target: int, rows: int) -> None:
        self.target, self.c, self.n, self.totals = target, None, 0, np.zeros(rows)
        self.near, self.least, self.labels = np.full(rows, np.inf), np.full(rows, np.inf), None

    def add(self, c: int | None, n: int, totals: np.ndarray, labels: bytes | None, near: bytes | None) -> None:
        if labels is not None:
            self.labels, self.near = np.frombuffer(labels, np.int64), np.frombuffer(near, np.float64).copy()
        if c is None:
            self.least = np.minimum(self.least, totals)
            return
        if c != self.c:
            self._close()
            self.c, self.n, self.totals = c, 0, np.zeros(len(totals))
        self.n += n
        self.totals += totals

    def _close(self) -> None:
        if self.c is None:
            return
        own = self.labels == self.c
        self.least = np.where(own, self.least, np.minimum(self.least, self.totals / self.n))
        if self.n > 1:
            self.near[own] = self.totals[own] / (self.n - 1)

    def result(self) -> pa.RecordBatch:
        self._close()
        found = [pa.array(x, mask=np.isinf(x)) for x in (self.near, self.least)]
        return pa.RecordBatch.from_arrays(found, ["a", "b"])
