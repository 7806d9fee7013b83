"""Scans of transaction files, database tables and segment documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.schema import RAW, SEGMENT_DOCUMENT
from tallyloom.sources.quoted_csv import RANGE_BYTES, read_quoted_csv


def read_transactions_csv(
    spark: SparkSession,
    path: str,
    infer_schema: bool = False,
    encoding: str = "UTF-8",
    multi_line: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Raw transaction lines with a header; quotes are doubled inside quoted fields.

    Malformed numbers become NULL. With ``multi_line`` quoted fields may hold line breaks: such files are read by
    byte ranges of ``range_bytes``, twice, and in Python workers, so switch it on only for them; without it, a record
    that such a line break cuts in two fails the job. ``infer_schema`` costs a pass over the data. UTF-8 and ISO-8859-1
    files can be split either way.
    """
    if multi_line:
        return read_quoted_csv(spark, path, None if infer_schema else RAW, encoding, range_bytes)
    reader = spark.read.options(header=True, quote='"', escape='"', encoding=encoding)
    schema = reader.option("inferSchema", True).csv(path).schema if infer_schema else RAW
    # A malformed line with an odd number of quotes is one part of a record that goes on in another line.
    marked = T.StructType([*schema.fields, T.StructField("__malformed", T.StringType())])
    options = {"columnNameOfCorruptRecord": "__malformed", "columnPruning": False}  # a pruned line is not checked
    lines = reader.schema(marked).options(**options).csv(path)
    quotes = F.length("__malformed") - F.length(F.translate("__malformed", '"', ""))
    place = F.coalesce(F.col(schema.fieldNames()[0]).cast("string"), F.lit("?"))
    hint = F.concat(F.lit("a quoted field holds a line break; read the file with multi_line=True; record "), place)
    whole = F.when(F.coalesce(quotes % 2 == 1, F.lit(False)), F.raise_error(hint).cast("boolean")).otherwise(True)
    return lines.filter(whole).select(*schema.fieldNames())


def read_jdbc(
    spark: SparkSession,
    table: str,
    url: str,
    properties: Mapping[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    single_connection: bool = False,
) -> DataFrame:
    """Database table in parallel range slices of ``partition_column``, or, only if asked for by
    ``single_connection``, in one task."""
    if partition_column is None:
        if not single_connection:
            raise ValueError("give the partition arguments, or single_connection=True to read in one task")
        return spark.read.jdbc(url=url, table=table, properties=dict(properties))
    return spark.read.jdbc(
        url=url,
        table=table,
        column=partition_column,
        lowerBound=lower_bound,
        upperBound=upper_bound,
        numPartitions=num_partitions,
        properties=dict(properties),
    )


def read_segment_documents(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = SEGMENT_DOCUMENT
) -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def flatten_segments(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("_id").alias("CustomerID"),
        F.col("rfm.recency").alias("Recency"),
        F.col("rfm.frequency").alias("Frequency"),
        F.col("rfm.monetary").alias("Monetary"),
        F.col("segment.cluster_id").alias("Cluster"),
        F.col("segment.label").alias("Segment"),
    )
