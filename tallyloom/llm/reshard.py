"""Moving a sharded table to new shards of given capacities with the fewest bytes moved.

A shard is a list of Parquet files, and a layout says which file lies in which shard. A minimum-cost flow from old
shard sizes to new capacities, where a byte that stays costs nothing and one that moves costs one, says how many
bytes go from which shard to which. Each old shard's files lie in a fixed order, and its flow cuts that order into one
block for each target. A file that lies within a block goes to its new shard as it is; only the files that a cut
goes through, at most one for each cut, are read and written anew, as one piece for each side.

A row's slot is its place in its file plus the rows of the files before it in the shard, so slots need no sort. The
driver sees one number per old shard, and the names of the files, as any scan of them does.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyloom.functions.staging import stage, stage_path

#: Rows that a file holds at most.
FILE_ROWS = 20_000


def row_size(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def transfers(old_sizes: dict[int, int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """The bytes that go from each old shard to each new one at the least cost, by shortest augmenting paths.

    The capacities must hold the old sizes. Old and new shards of the same number are the same place.
    """
    if sum(old_sizes.values()) > sum(capacities):
        raise ValueError("the new capacities are too small")
    source, sink = ("source",), ("sink",)
    room: dict[tuple, dict[tuple, int]] = {source: {}, sink: {}}
    cost: dict[tuple, int] = {}

    def edge(a, b, capacity, price):
        room.setdefault(a, {})[b] = capacity
        room.setdefault(b, {}).setdefault(a, 0)
        cost[a, b], cost[b, a] = price, -price

    for old, size in sorted(old_sizes.items()):
        edge(source, ("old", old), size, 0)
        for new in range(len(capacities)):
            edge(("old", old), ("new", new), size, int(old != new))
    for new, capacity in enumerate(capacities):
        edge(("new", new), sink, capacity, 0)
    while True:
        # Cheapest path in the residual graph; costs may be negative there, but no cycle is.
        price, came, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            at = queue.popleft()
            queued.discard(at)
            for to, left in room[at].items():
                if left and price[at] + cost[at, to] < price.get(to, 1 << 62):
                    price[to], came[to] = price[at] + cost[at, to], at
                    if to not in queued:
                        queue.append(to)
                        queued.add(to)
        if sink not in came:
            break
        path, at = [], sink
        while at != source:
            path.append((came[at], at))
            at = came[at]
        amount = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= amount
            room[b][a] += amount
    sent = ((old, new, room[("new", new)].get(("old", old), 0)) for old in old_sizes for new in range(len(capacities)))
    return {(old, new): n for old, new, n in sent if n}


def write_shards(docs: DataFrame, shard: Column, path: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write ``docs`` as shards of files of at most ``file_rows`` rows to ``path`` and return their layout.

    ``shard`` is a number from 0 that is null for no row. A row keeps all its columns, in one struct, so no name clashes.
    A hot shard is written by as many tasks as its bytes fill.
    """
    rows = docs.select(F.struct("*").alias("row"), row_size(F.col("text")).alias("size"), shard.cast("int").alias("shard"))
    rows = rows.hint("rebalance", "shard").withColumn("old_shard", F.col("shard"))
    rows.write.option("maxRecordsPerFile", file_rows).partitionBy("shard", "old_shard").parquet(path)
    return layout_of(docs.sparkSession, path)


def layout_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, shard, old_shard, rows, bytes) for each file under ``path``; only the sizes of the rows are read."""
    sizes = spark.read.schema("size long, shard int, old_shard int").parquet(path)
    by_file = sizes.groupBy(F.col("_metadata.file_path").alias("file"), "shard", "old_shard")
    return stage(by_file.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")), "layout")


@dataclass(frozen=True)
class Reshard:
    """The new layout, the bytes that change their shard and the bytes that were written to that end."""

    layout: DataFrame
    moved_bytes: int
    written_bytes: int


def _files(spark: SparkSession, names: list[str], row: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField("row", row), T.StructField("size", T.LongType())])
    columns = ["row", "size", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth")]
    if not names:
        return spark.createDataFrame([], schema).select("row", "size", F.lit("").alias("file"), F.lit(0).cast("long").alias("nth"))
    return spark.read.schema(schema).parquet(*names).select(*columns)


def reshard(layout: DataFrame, row: T.StructType, shards: int, capacities: list[int] | None = None, path: str | None = None) -> Reshard:
    """Move a layout to ``shards`` new shards; ``row`` is the schema of the table, ``path`` where new files go.

    Without ``capacities`` the new shards get equal sizes. A row goes where the block that its middle lies in goes, so a
    shard misses its capacity by half a row at each of its cuts at most. Null texts have size 1. An empty layout stays
    empty. Files of the old layout are never changed.
    """
    spark = layout.sparkSession
    path = path or stage_path(spark, "shards")
    sizes = {r["shard"]: r["n"] for r in layout.groupBy("shard").agg(F.sum("bytes").alias("n")).collect()}
    moves = transfers(sizes, capacities or even_capacities(sum(sizes.values()), shards))
    cuts, reached = [], dict.fromkeys(sizes, 0)
    # What stays comes first in a shard's order, then the blocks for the others by their numbers.
    for (old, new), amount in sorted(moves.items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        cuts.append((old, reached[old], reached[old] + amount, new))
        reached[old] += amount
    # One row per transfer, so at most old shards times new ones.
    blocks = F.broadcast(spark.createDataFrame(cuts, "shard int, first long, past long, target int"))
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    met = layout.withColumn("start", start).join(blocks, "shard").where("first < start + bytes and start < past")
    whole = F.expr("first <= start and start + bytes <= past")
    placed = stage(met.withColumn("whole", whole), "blocks")
    kept = placed.where("whole").select("file", F.col("target").alias("shard"), "old_shard", "rows", "bytes")

    torn = placed.where("not whole")
    names = [r["file"] for r in torn.select("file").distinct().orderBy("file").collect()]  # at most one per cut
    order = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)  # the rows of one file
    pieces = _files(spark, names, row).withColumn("upto", F.sum("size").over(order))
    places = torn.select("file", "old_shard", "start", "first", "past", F.col("target").alias("shard"))
    middle = F.col("start") + F.col("upto") - F.expr("(size + 1) div 2")
    sided = pieces.join(places, "file").where((middle >= F.col("first")) & (middle < F.col("past")))
    sided.select("row", "size", "shard", "old_shard").write.partitionBy("shard", "old_shard").parquet(path)
    written = layout_of(spark, path) if names else kept.limit(0)
    changed = sum(amount for (old, new), amount in moves.items() if old != new)
    return Reshard(stage(kept.unionByName(written), "layout"), changed, written.agg(F.sum("bytes")).first()[0] or 0)


def sharded_rows(layout: DataFrame, row: T.StructType) -> DataFrame:
    """The rows of a layout, each in the struct ``row``, with ``size``, ``shard``, ``old_shard`` and ``slot``, its place in
    the shard without gaps from 0: the files of a shard follow each other by name."""
    names = [r["file"] for r in layout.select("file").orderBy("file").collect()]  # as Spark's own scan lists them
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = layout.select("file", "shard", "old_shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    rows = _files(layout.sparkSession, names, row).join(stage(firsts, "firsts"), "file")
    return rows.select("row", "size", "shard", "old_shard", (F.col("first") + F.col("nth")).alias("slot"))
