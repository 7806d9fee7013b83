"""Reading the given tables and small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space of words and line keys: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The maximal runs of characters outside ``BLANKS``; no text has no words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    empty = F.array().cast("array<string>")
    return F.when(F.length(trimmed) == 0, empty).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body refers to it."""
    return F.transform(F.array(value), body)[0]


def release_memory() -> None:
    """Give the memory that this process has freed back to the system: Python's, Arrow's and, where the C library can,
    that of NumPy's arrays, which Arrow's pools leave where it is."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim:
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; once they are done, the worker, which Spark keeps for later tasks, returns the memory it has freed."""
    yield from batches
    release_memory()


def slices(batches: Iterator[pa.RecordBatch], column: str, most_chars: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice come to about ``most_chars`` bytes; a longer text stands alone."""
    for batch in batches:
        start, size = 0, 0
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        for at, length in enumerate(sizes):
            size += length or 0
            if size >= most_chars:
                yield batch.slice(start, at + 1 - start)
                start, size = at + 1, 0
        if start < len(sizes):
            yield batch.slice(start)
