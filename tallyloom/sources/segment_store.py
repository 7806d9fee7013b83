"""Keyed store of customer segment documents.

``SegmentStore`` keeps the documents in hash buckets. A version is a manifest that lists the files of every bucket. An
upsert rewrites the buckets that its batch touches, lists the files of the others again, and never changes a file. A
version counts once its manifest is committed, which is the last step, so a failed write leaves the one before as it
was; two writers of the same version cannot both succeed.

``upsert_segments`` is the plain form, which merges a whole Parquet table into a new folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tallyloom.functions.files import delete, file_list, folders_in, is_written
from tallyloom.functions.staging import stage
from tallyloom.schema import SEGMENT_DOCUMENT


def segment_documents(labelled: DataFrame, cluster: str = "cluster", label: str = "segment_label") -> DataFrame:
    """Nested documents ``_id, rfm{...}, segment{...}`` from labelled RFM rows."""
    return labelled.select(
        F.col("CustomerID").cast("string").alias("_id"),
        F.struct(
            F.col("Recency").cast("int").alias("recency"),
            F.col("Frequency").cast("int").alias("frequency"),
            F.col("Monetary").cast("double").alias("monetary"),
        ).alias("rfm"),
        F.struct(
            F.col(cluster).cast("int").alias("cluster_id"),
            F.col(label).cast("string").alias("label"),
        ).alias("segment"),
    )


def latest_per_key(batch: DataFrame, order_by: str | None = None) -> DataFrame:
    """One document per (non-NULL) ``_id``: the one with the greatest ``order_by`` value, ties by content."""
    fields = [c for c in batch.columns if c not in ("_id", order_by)]
    document = F.struct(*fields)
    order = F.struct(*[c for c in [order_by, *fields] if c is not None])
    return batch.filter(F.col("_id").isNotNull()).groupBy("_id").agg(F.max_by(document, order).alias("doc")).select("_id", "doc.*")


def merge_documents(store: DataFrame, batch: DataFrame, order_by: str | None = None) -> DataFrame:
    """Store after the upsert: batch fields replace stored ones, unseen ids are added, the rest is kept.

    A NULL in the batch overwrites; a top-level field that the batch lacks keeps its stored value.
    """
    return _merged(store, latest_per_key(batch, order_by))


def _merged(store: DataFrame, fresh: DataFrame) -> DataFrame:
    """``merge_documents`` for a batch with one document per key."""
    incoming = [c for c in fresh.columns if c != "_id"]
    renamed = fresh.select(
        F.col("_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in incoming]
    )
    matched = F.col("__id").isNotNull()

    def merged(name: str):
        if name not in incoming:
            return F.col(name)
        if name not in store.columns:
            return F.col(f"__{name}").alias(name)
        return F.when(matched, F.col(f"__{name}")).otherwise(F.col(name)).alias(name)

    fields = [c for c in store.columns if c != "_id"] + [c for c in incoming if c not in store.columns]
    joined = store.join(renamed, store["_id"] == renamed["__id"], "full_outer")
    return joined.select(F.coalesce("_id", "__id").alias("_id"), *[merged(c) for c in fields])


def upsert_segments(
    batch: DataFrame, new_version: str, old_version: str | None = None, order_by: str | None = None
) -> DataFrame:
    """Merge ``batch`` into the store at ``old_version`` (none yet: start one) and write ``new_version``."""
    spark = batch.sparkSession
    if old_version is None:
        merged = latest_per_key(batch, order_by)
    else:
        if old_version.rstrip("/") == new_version.rstrip("/"):
            raise ValueError("a store version cannot be merged onto itself")
        merged = merge_documents(spark.read.parquet(old_version), batch, order_by)
    merged.write.mode("errorifexists").parquet(new_version)
    return spark.read.parquet(new_version)


def push_documents(documents: DataFrame, send_partition: Callable[[Iterator[Row]], None]) -> None:
    """Hand each partition to a client of an external document store, from the executors.

    ``send_partition`` must write by key, so that a rerun task repeats its writes harmlessly.
    """
    documents.foreachPartition(send_partition)


#: One row per file of a version, and one with bucket -1 that says how the version is made.
MANIFEST = "bucket int, path string, bytes long, about string"


class SegmentStore:
    """A store under the folder ``root``, in ``buckets`` hash buckets of the ids.

    ``buckets`` holds for a new store; take about as many as the store will have files. An old one keeps its own number.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.new_buckets = spark, root.rstrip("/"), buckets

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/versions/{version:09d}"

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        names = folders_in(self.spark, f"{self.root}/versions")
        return [int(n) for n in names if n.isdigit() and is_written(self.spark, self._manifest_path(int(n)))]

    def manifest(self, version: int | None = None) -> DataFrame:
        """(bucket, path, bytes) for each file of a version, by default the last one."""
        return self._rows(version).where("bucket >= 0").select("bucket", "path", "bytes")

    def _rows(self, version: int | None) -> DataFrame:
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError(f"no version {'' if version is None else version} in the store at {self.root}")
        return self.spark.read.schema(MANIFEST).parquet(self._manifest_path(known[-1] if version is None else version))

    def _about(self, version: int | None) -> tuple[int, T.StructType]:
        about = json.loads(self._rows(version).where("bucket = -1").first()["about"])
        return about["buckets"], T.StructType.fromJson(about["schema"])

    def _read(self, files: DataFrame, schema: T.StructType) -> DataFrame:
        """The documents in the given files; a field that a file was written without is NULL in its documents."""
        paths = [row["path"] for row in files.select("path").orderBy("path").collect()]  # as Spark's own scan lists them
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The documents of a version, by default the last one; an empty table if there is none yet."""
        if version is None and not self.versions():
            return self.spark.createDataFrame([], SEGMENT_DOCUMENT)
        return self._read(self.manifest(version), self._about(version)[1])

    def upsert(self, batch: DataFrame, order_by: str | None = None) -> int:
        """Merge a batch by the rules of ``merge_documents`` and return the new version's number.

        Repeating an upsert changes nothing. A batch without any key gives a version with the files of the last one.
        """
        known = self.versions()
        buckets, schema = self._about(None) if known else (self.new_buckets, None)
        old_files = self.manifest() if known else self.spark.createDataFrame([], "bucket int, path string, bytes long")

        def bucket() -> Column:
            return F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(buckets)).cast("int").alias("bucket")

        fresh = stage(latest_per_key(batch, order_by), "upsert-batch")
        touched = stage(fresh.select(bucket()).distinct(), "upsert-buckets")  # at most one row per bucket
        merged = fresh if schema is None else _merged(self._read(old_files.join(touched, "bucket", "left_semi"), schema), fresh)
        data = f"{self.root}/data/{uuid.uuid4().hex}"
        # Rebalancing splits large buckets into files of even size.
        merged.select("*", bucket()).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(data)

        number = F.regexp_extract("path", r"/bucket=(\d+)/", 1).cast("int")
        written = file_list(self.spark, data).select(number.alias("bucket"), "path", F.col("length").alias("bytes"))
        kept = old_files.join(touched, "bucket", "left_anti").select("bucket", "path", "bytes")
        about = json.dumps({"buckets": buckets, "schema": merged.schema.jsonValue()})
        head = self.spark.createDataFrame([(-1, None, None, about)], MANIFEST)
        files = kept.unionByName(written).withColumn("about", F.lit(None).cast("string"))
        version = (known[-1] if known else 0) + 1
        head.unionByName(files).write.mode("errorifexists").parquet(self._manifest_path(version))
        return version

    def forget(self, keep: int = 1) -> None:
        """Delete all but the last ``keep`` versions, and the data folders that no kept version lists a file of.

        Not to be called while another writer is at work.
        """
        known = self.versions()
        for version in known[: max(0, len(known) - keep)]:
            delete(self.spark, self._manifest_path(version))
        folder = F.regexp_extract("path", r"/data/([0-9a-f]+)/", 1).alias("folder")
        used: set[str] = set()
        for version in self.versions():
            used |= {row["folder"] for row in self.manifest(version).select(folder).distinct().collect()}  # one per upsert
        for name in set(folders_in(self.spark, f"{self.root}/data")) - used:
            delete(self.spark, f"{self.root}/data/{name}")
