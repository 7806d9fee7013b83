"""What the files of a sales store hold, kept beside them, so that choices and reports are planned without the sales.

The manifest has a row for each country of each file: its lines and its first and last time. It lies in a folder of the
store that Spark's readers pass over. A file that a broken write left without rows gets them when the manifest is next
asked for, and rows of files that are gone are not used.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.files import exists, file_list
from tallyloom.operators.enrichment import domain_of, filter_date_country
from tallyloom.schema import DEFAULT_COUNTRIES

MANIFEST = "_manifest"
SCHEMA = "file string, Country string, lines long, first timestamp, last timestamp"


def _name(path: Column | str) -> Column:
    """The file's place in the store: month folder and name."""
    return F.substring_index(path, "/", -2)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return file_list(spark, path).select(_name("path").alias("file")).where(F.col("file").endswith(".parquet"))


def _known(spark: SparkSession, path: str) -> DataFrame:
    place = f"{path}/{MANIFEST}"
    return spark.read.schema(SCHEMA).parquet(place) if exists(spark, place) else spark.createDataFrame([], SCHEMA)


def sales_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of the sales at ``path``, after files without rows were read for theirs."""
    path = path.rstrip("/")
    files = _files(spark, path)
    missing = [row["file"] for row in files.join(_known(spark, path), "file", "left_anti").orderBy("file").collect()]
    if missing:
        figures = (
            spark.read.option("basePath", path)
            .parquet(*[f"{path}/{name}" for name in missing])
            .groupBy(_name(F.col("_metadata.file_path")).alias("file"), "Country")
            .agg(F.count(F.lit(1)).alias("lines"), F.min("InvoiceTS").alias("first"), F.max("InvoiceTS").alias("last"))
        )
        figures.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")  # a few rows a file
    return _known(spark, path).join(files, "file", "left_semi")


def stored_filter_domain(
    spark: SparkSession, path: str, defaults: Sequence[str] = tuple(DEFAULT_COUNTRIES), fallback: int = 5
) -> DataFrame:
    """``filter_domain`` of the sales at ``path``, from the manifest alone."""
    per_country = sales_manifest(spark, path).groupBy("Country").agg(
        F.to_date(F.min("first")).alias("first"), F.to_date(F.max("last")).alias("last")
    )
    return domain_of(per_country, defaults, fallback)


def read_sales(spark: SparkSession, path: str, start: dt.date, end: dt.date, countries: Sequence[str]) -> DataFrame:
    """``filter_date_country`` over the sales at ``path``; files without such a country in that time are not opened."""
    path = path.rstrip("/")
    inside = (F.col("last") >= F.lit(start.isoformat()).cast("timestamp")) & (
        F.col("first") < F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp")
    )
    wanted = sales_manifest(spark, path).where(inside & F.col("Country").isin(list(countries))).select("file").distinct()
    names = [row["file"] for row in wanted.orderBy("file").collect()]  # as Spark's own scan lists its files
    schema = spark.read.parquet(path).schema
    if not names:
        return spark.createDataFrame([], schema)
    sales = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{name}" for name in names])
    return filter_date_country(sales, start, end, countries)
