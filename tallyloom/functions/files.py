"""Names of files and folders, by the file systems that Spark knows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if there is no such path. Meant for folders that hold few others."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to ``path`` and its job committed."""
    return exists(spark, f"{path}/_SUCCESS")


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of the files under ``path``, listed by Spark; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
