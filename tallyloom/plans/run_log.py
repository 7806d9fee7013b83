"""What a run has finished, so that a run that was killed goes on after its last whole stage.

A run works in a folder named by the fingerprint of its inputs and settings. A stage there is a table and a mark;
the mark is written last, holds the stage's facts, and counts once Spark has committed it. A stage that has a
mark is read, any other one is made again from the start. Applications that worked on the run are noted, so that
the next one can delete what they stored for themselves.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.files import delete, file_list, folders_in, is_written
from tallyloom.functions.staging import stage_path, stage_root

Facts = dict[str, Any]


def fingerprint(spark: SparkSession, inputs: Sequence[str], **settings: Any) -> str:
    """A name for these settings and the names, lengths and times of all files under ``inputs``."""
    sums = []
    for path in sorted(inputs):
        about = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        sums.append([str(v) for v in file_list(spark, path).agg(F.count(F.lit(1)), F.sum(about)).first()])
    said = json.dumps([sums, settings], sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()[:32]


class RunLog:
    """The stages of one run under ``root``; without a root they last as long as the application's own tables."""

    def __init__(self, spark: SparkSession, root: str | None = None, name: str = "run"):
        self.spark, self.lasting = spark, root is not None
        self.folder = f"{root.rstrip('/')}/{name}" if root is not None else stage_path(spark, name)
        if self.lasting:
            self._take_over()

    def _take_over(self) -> None:
        """Delete the tables that earlier applications stored while they worked on this run, and note this one."""
        own = stage_root(self.spark)
        noted = f"{self.folder}/applications"
        for name in folders_in(self.spark, noted):
            row = self.spark.read.parquet(f"{noted}/{name}").first() if is_written(self.spark, f"{noted}/{name}") else None
            if row is not None and row["tables"] != own:
                delete(self.spark, row["tables"])
                delete(self.spark, f"{noted}/{name}")
        app = self.spark.sparkContext.applicationId
        self.spark.createDataFrame([(own,)], "tables string").write.mode("overwrite").parquet(f"{noted}/{app}")

    def facts(self, name: str) -> Facts | None:
        """The facts of a finished stage, or None."""
        path = f"{self.folder}/{name}/mark"
        return json.loads(self.spark.read.parquet(path).first()["facts"]) if is_written(self.spark, path) else None

    def once(self, name: str, action: Callable[[], Facts]) -> Facts:
        """The facts of a stage that ``action`` carries out unless an earlier attempt has. An attempt that was killed
        may have begun it, so an action must bear to be repeated."""
        known = self.facts(name)
        if known is None:
            known = action()
            marked = self.spark.createDataFrame([(json.dumps(known),)], "facts string")
            marked.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{name}/mark")
        return known

    def table(self, name: str, make: Callable[[], tuple[DataFrame, Callable[[], Facts]]]) -> tuple[DataFrame, Facts]:
        """The stored table of a stage and its facts, which are asked for after the table was written."""
        path = f"{self.folder}/{name}/table"

        def write() -> Facts:
            df, facts = make()
            df.write.mode("overwrite").parquet(path)
            return facts()

        facts = self.once(name, write)
        return self.spark.read.parquet(path), facts

    def discard(self) -> None:
        """Delete the stages of this run; call it once nothing reads them any more."""
        delete(self.spark, self.folder)
