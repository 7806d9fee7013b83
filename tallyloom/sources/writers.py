"""Distributed sinks. Failures are raised to the caller."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tallyloom.functions.columns import year_month
from tallyloom.schema import EXPORT_COLUMNS
from tallyloom.sources.sales_store import sales_manifest


def export_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] = tuple(EXPORT_COLUMNS),
    mode: str = "overwrite",
    single_file: bool = False,
) -> None:
    """Write the named columns as headed CSV part files, keeping padding inside text fields.

    ``single_file`` sends everything through one task; it is meant for small results only.
    """
    out = df.select(*columns)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_jdbc(
    df: DataFrame,
    table: str,
    url: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    num_partitions: int | None = None,
) -> None:
    """Write to a database table in ``overwrite`` or ``append`` mode over at most ``num_partitions`` connections."""
    writer = df.write.mode(mode)
    if num_partitions is not None:
        writer = writer.option("numPartitions", num_partitions)
    writer.jdbc(url=url, table=table, properties=dict(properties))


def write_sales(sales: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store dated sales as Parquet in one folder per month (column YearMonth), and a manifest of what each file holds.

    Rebalancing gives each month files of even size: small months are merged, large ones are split.
    """
    by_month = sales.withColumn("YearMonth", year_month()).hint("rebalance", "YearMonth")
    by_month.write.mode(mode).partitionBy("YearMonth").parquet(path)
    sales_manifest(sales.sparkSession, path)
