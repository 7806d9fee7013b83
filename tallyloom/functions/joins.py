"""Joins on keys of unknown skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.staging import stage

#: The longest list of hot keys that is broadcast; with more of them the rows are dealt out by ranges instead.
MOST_LISTED_KEYS = 10_000
#: Parts that rows without a key are spread over.
NULL_PARTS = 10_000


def skew_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    task_rows: int = 1_000_000,
    row_count: str | None = None,
) -> DataFrame:
    """Shuffle join of ``rows`` to ``lookup`` in which a hot key is spread over as many tasks as its rows fill.

    A key is hot above ``task_rows`` rows, however many such keys there are. The list of hot keys is stored first. If it is
    short, each gets one salt for every ``task_rows`` rows, and only its lookup rows are copied; the salt depends on
    the row and its input partition alone, hence is the same when a task reruns. A longer list is never sent to the
    tasks: then the rows are stored in ranges of (key, hash) of about ``task_rows`` each, and a lookup row goes to every
    range that its key lies in. ``how`` is inner, left or left_semi; rows with a NULL key are spread as well. If the
    lookup was aggregated from ``rows`` and holds each key's number of rows, name that column in ``row_count`` to save the
    counting pass; it is left out of the result. Such a lookup, and ``rows``, should be stored tables.
    """
    if row_count is None:
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    else:
        counts = lookup.select(key, F.col(row_count).alias("__rows"))
        lookup = lookup.drop(row_count)
    hot = counts.filter(F.col(key).isNotNull() & (F.col("__rows") > task_rows))
    heavy = stage(hot.select(key, F.ceil(F.col("__rows") / task_rows).cast("int").alias("__salts")), "hot-keys")
    spread = F.xxhash64(*[F.col(c) for c in rows.columns]) + F.spark_partition_id()
    if heavy.count() > MOST_LISTED_KEYS:
        return _range_join(rows, lookup, key, how, task_rows, spread)
    salts = F.when(F.col(key).isNull(), NULL_PARTS).otherwise(F.coalesce("__salts", F.lit(1)))
    salted_rows = rows.join(F.broadcast(heavy), key, "left").withColumn("__salt", F.pmod(spread, salts).cast("int"))
    salted_lookup = lookup.join(F.broadcast(heavy), key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    )
    joined = salted_rows.drop("__salts").join(salted_lookup.drop("__salts"), [key, "__salt"], how)
    return joined.drop("__salt")


def _range_join(rows: DataFrame, lookup: DataFrame, key: str, how: str, task_rows: int, spread: Column) -> DataFrame:
    ranges = max(1, -(-rows.count() // task_rows))
    dealt = rows.withColumn("__spread", spread).repartitionByRange(ranges, key, "__spread")
    ranged = stage(dealt.drop("__spread").withColumn("__salt", F.spark_partition_id()), "key-ranges")
    # a key lies in as many ranges as its rows fill, so neither side of this join has a hot key
    places = ranged.filter(F.col(key).isNotNull()).select(key, "__salt").distinct()
    placed = lookup.join(places, key)
    return ranged.join(placed, [key, "__salt"], how).drop("__salt")
