"""Connected components of a graph given as undirected links, by hooking and pointer jumping.

Every round hooks each node to its smallest neighbour if that is smaller, follows the pointers to their roots
and contracts the links, until none is left. All state is in stored tables, so a lost executor costs the current
step only; a hub's rows meet one row per key in joins that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.staging import stage


def _moved(rows: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by what it points to, if it points anywhere."""
    to = pointers.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    joined = rows.join(to, rows[column] == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_parent", column)).drop("_node", "_parent")


def roots(pointers: DataFrame) -> DataFrame:
    """Pointers (node, parent) with parent < node, followed to the ends."""
    while True:
        jumped = pointers.select("node", F.col("parent").alias("old"), "parent")
        jumped = stage(_moved(_moved(jumped, "parent", pointers), "parent", pointers), "pointers")
        pointers = jumped.select("node", "parent")
        if jumped.where("old <> parent").isEmpty():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """From links (a, b): every node that has one, with ``component``, the smallest node it reaches."""
    links = stage(links.where("a <> b").select("a", "b"), "links")
    both = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stage(both.select("node", F.col("node").alias("component")), "labels")
    while not links.isEmpty():
        ways = links.select(F.explode(F.expr("array(struct(a as node, b as near), struct(b as node, a as near))")).alias("x"))
        hooks = ways.select("x.*").groupBy("node").agg(F.min("near").alias("parent")).where("parent < node")
        pointers = roots(stage(hooks, "hooks"))
        labels = stage(_moved(labels, "component", pointers), "labels")
        links = stage(_moved(_moved(links, "a", pointers), "b", pointers).where("a <> b").distinct(), "links")
    return labels
