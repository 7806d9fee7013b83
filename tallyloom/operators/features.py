"""Encoding and scaling of model features, as plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.running import running_total
from tallyloom.functions.staging import stage


def frequency_index(df: DataFrame, column: str, out: str) -> tuple[DataFrame, int]:
    """Labels of ``column`` numbered from 0 by descending frequency, ties by label, and their number.

    The labels are a stored table, numbered by ranges; however many there are, none passes through the driver.
    """
    label = F.col(column).cast("string").alias(column)
    counts = df.filter(F.col(column).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    ones = counts.select(column, "n", F.lit("").alias("all"), F.lit(1).alias("one"))
    numbered = running_total(ones, ["all"], [F.desc("n"), F.col(column)], "one", "place", "label-ranges")
    labels = stage(numbered.select(column, (F.col("place") - 1).cast("double").alias(out)), "labels")
    return labels, labels.count()


def encode_by_frequency(df: DataFrame, column: str, out: str, on_missing: str = "keep") -> DataFrame:
    """Add ``out``, the frequency rank of ``column``.

    ``on_missing='keep'`` gives a NULL label the number of labels as index; ``'error'`` fails the job. The label
    table's size is known, so Spark broadcasts it if small; else adaptive execution splits hot labels.
    """
    if on_missing not in ("keep", "error"):
        raise ValueError("on_missing must be 'keep' or 'error'")
    labels, n = frequency_index(df, column, out)
    joined = df.join(labels, column, "left")
    if on_missing == "keep":
        missing: Column = F.lit(float(n))
    else:
        missing = F.raise_error(F.lit(f"{column} has a missing label")).cast("double")
    return joined.select(*df.columns, F.coalesce(out, missing).alias(out))


def _statistics(df: DataFrame, columns: Sequence[str], population: bool = False) -> Column:
    """One-row statistics of all columns as a struct, read once as a scalar subquery."""
    deviation = F.stddev_pop if population else F.stddev_samp
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        parts += [
            F.min(value).alias(f"min_{c}"),
            F.max(value).alias(f"max_{c}"),
            F.avg(value).alias(f"mean_{c}"),
            F.coalesce(deviation(value), F.lit(0.0)).alias(f"std_{c}"),
        ]
    return df.groupBy().agg(F.struct(*parts)).scalar()


def _min_max(c: str) -> Column:
    spread = F.col(f"s.max_{c}") - F.col(f"s.min_{c}")
    scaled = (F.col(c) - F.col(f"s.min_{c}")) / spread
    return F.when(spread > 0, scaled).when(F.col(c).isNotNull(), 0.5)


def _z_score(c: str) -> Column:
    std = F.col(f"s.std_{c}")
    return F.when(std > 0, (F.col(c) - F.col(f"s.mean_{c}")) / std).when(F.col(c).isNotNull(), 0.0)


def min_max_scale(df: DataFrame, column: str, out: str) -> DataFrame:
    """Rescale to [0, 1]; a constant column becomes 0.5."""
    return df.withColumn("s", _statistics(df, [column])).withColumn(out, _min_max(column)).drop("s")


def z_score_scale(df: DataFrame, columns: dict[str, str], population: bool = False) -> DataFrame:
    """Centre and divide by the sample (or population) deviation; a constant column becomes 0.

    ``columns`` maps each input column to its output column.
    """
    scaled = df.withColumn("s", _statistics(df, list(columns), population))
    return scaled.withColumns({out: _z_score(c) for c, out in columns.items()}).drop("s")


def transform_features(df: DataFrame) -> DataFrame:
    """Quantity and UnitPrice as doubles, plus Quantity_Normalized and UnitPrice_Standardized."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in ("Quantity", "UnitPrice")})
    return (
        typed.withColumn("s", _statistics(typed, ["Quantity", "UnitPrice"]))
        .withColumns(
            {"Quantity_Normalized": _min_max("Quantity"), "UnitPrice_Standardized": _z_score("UnitPrice")}
        )
        .drop("s")
    )
