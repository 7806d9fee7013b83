"""Exact interpolated percentiles that never gather a whole column in one place.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here a sketch first
brackets each wanted rank, a counting pass fixes how many rows lie below and inside each bracket, and
only the values of the bracket that holds the rank are sorted, by ranges. The counts are exact, so the answer is
exact even if the sketch misses: then the neighbouring zone is searched instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.running import running_total

SKETCH_ACCURACY = 10_000


def percentile_name(prob: float) -> str:
    return f"p{prob * 100:g}"


def percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per (group, column): ``*by, column_name, p25, p50, ...`` with linear interpolation.

    ``df`` is read three times (once with ``approx``, which returns sketch values), so hand in a stored
    table. NULL values and NULL groups are left out.
    """
    keys = [*by, "column_name"]
    values = (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(list(by), list(columns), "column_name", "v")
        .dropna(subset=[*by, "v"])
    )
    if approx:
        sketch = F.approx_percentile("v", list(probs), accuracy)
        return values.groupBy(*keys).agg(sketch.alias("q")).select(
            *keys, *[F.col("q")[i].alias(percentile_name(p)) for i, p in enumerate(probs)]
        )

    margin = 3.0 / accuracy
    edges = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    brackets = _small(
        values.groupBy(*keys).agg(
            F.count("v").alias("total"), F.approx_percentile("v", edges, accuracy).alias("edges")
        ),
        bool(by),
    )

    def zone(lower: Column, upper: Column) -> Column:
        return F.when(F.col("v") < lower, 0).when(F.col("v") <= upper, 1).otherwise(2)

    counted = values.join(brackets, keys).groupBy(*keys, "total", "edges").agg(
        *[F.count_if(F.col("v") < F.col("edges")[2 * i]).alias(f"below{i}") for i in range(len(probs))],
        *[F.count_if(F.col("v") <= F.col("edges")[2 * i + 1]).alias(f"upto{i}") for i in range(len(probs))],
    )

    def target(i: int, prob: float) -> Column:
        position = (F.col("total") - 1) * F.lit(float(prob))
        first, last = F.floor(position), F.ceil(position)

        def rank_zone(rank: Column) -> Column:
            return F.when(rank < F.col(f"below{i}"), 0).when(rank < F.col(f"upto{i}"), 1).otherwise(2)

        return F.struct(
            F.lit(i).alias("i"),
            first.alias("first"),
            last.alias("last"),
            (position - first).alias("fraction"),
            F.col("edges")[2 * i].alias("lower"),
            F.col("edges")[2 * i + 1].alias("upper"),
            rank_zone(first).alias("zone_from"),
            rank_zone(last).alias("zone_to"),
            F.when(first < F.col(f"below{i}"), F.lit(0).cast("bigint"))
            .when(first < F.col(f"upto{i}"), F.col(f"below{i}"))
            .otherwise(F.col(f"upto{i}"))
            .alias("before"),
        )

    targets = _small(
        counted.select(*keys, F.inline(F.array(*[target(i, p) for i, p in enumerate(probs)]))), bool(by)
    )
    inside = zone(F.col("lower"), F.col("upper")).between(F.col("zone_from"), F.col("zone_to"))
    found = values.join(targets, keys).filter(inside)
    per_value = found.groupBy(*keys, "i", "v", "first", "last", "fraction", "before").agg(
        F.count(F.lit(1)).alias("n")
    )
    # a bracket spans as many ranges of values as it fills, whatever the sketch left in it
    totals = running_total(per_value, [*keys, "i"], [F.col("v")], "n", "upto", "percentile-ranges")
    ranked = totals.withColumn("end", F.col("before") + F.col("upto")).withColumn("start", F.col("end") - F.col("n"))

    def at(i: int, rank: str) -> Column:
        here = (F.col("i") == i) & (F.col("start") <= F.col(rank)) & (F.col(rank) < F.col("end"))
        return F.max(F.when(here, F.col("v")))

    def interpolated(i: int) -> Column:
        low, high = at(i, "first"), at(i, "last")
        return low + (high - low) * F.max(F.when(F.col("i") == i, F.col("fraction")))

    return ranked.groupBy(*keys).agg(
        *[interpolated(i).alias(percentile_name(p)) for i, p in enumerate(probs)]
    )


def _small(df: DataFrame, grouped: bool) -> DataFrame:
    """A per-group table: without groups it has one row per column and is broadcast, else Spark decides."""
    return df if grouped else F.broadcast(df)
