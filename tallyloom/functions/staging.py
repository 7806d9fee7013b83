"""Written intermediate tables: cut lineage once, read back as columnar files many times.

Tables go to the shared folder in ``spark.checkpoint.dir``, so they outlive lost executors. Only a
local-mode session without that setting falls back to a temporary folder of this machine.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.files import delete

_local_roots: dict[str, str] = {}
_scopes: list[str] = []


def stage_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/tallyloom/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_roots[app]


def stage_path(spark: SparkSession, label: str) -> str:
    return "/".join([stage_root(spark), *_scopes, f"{label}-{uuid.uuid4().hex}"])


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return a scan of it."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end: consume the results (write or collect them) before."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    path = "/".join([stage_root(spark), *_scopes])
    try:
        yield
    finally:
        _scopes.pop()
        delete(spark, path)


def clear_stages(spark: SparkSession) -> None:
    """Delete every table this application staged; call it once no result reads them any more."""
    delete(spark, stage_root(spark))
