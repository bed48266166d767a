"""Run logs that stay readable after thousands of loads.

An append is one small file in the tail. When the tail has grown beyond TAIL files, all rows
are written once more into one checkpoint, with the names of the files it takes in. A
checkpoint counts from the moment its list of names is complete, which is written last, so
readers see the old state or the new one. What it took in is deleted only by the checkpoint
after it; a reader that chose the one before still finds its files, and a row appended while a
checkpoint is written is in no list and so stays in the tail.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shopstar.sources import store

TAIL = 32
_NAMES = "names"


class RunLog:
    """The rows of one log: a checkpoint and the tail files that it does not have."""

    def __init__(self, spark: SparkSession, folder: str, layout: str, tail: int = TAIL):
        self.spark = spark
        self.folder = folder
        self.schema = StructType.fromDDL(layout)
        self.tail = tail

    @property
    def _checkpoints(self) -> str:
        return f"{self.folder}_checkpoints"

    def _newest(self) -> str | None:
        """The last complete checkpoint."""
        for name in reversed(store.listing(self.spark, self._checkpoints)):
            if store.exists(self.spark, f"{self._checkpoints}/{name}/{_NAMES}/_SUCCESS"):
                return f"{self._checkpoints}/{name}"
        return None

    def _taken(self, checkpoint: str | None) -> set[str]:
        if checkpoint is None:
            return set()
        return {r["name"] for r in self.spark.read.schema("name STRING").parquet(f"{checkpoint}/{_NAMES}").collect()}

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """Checkpoint, the files it took in, and the files after it."""
        checkpoint = self._newest()
        taken = self._taken(checkpoint)
        files = [f for f in store.listing(self.spark, self.folder) if f.endswith(".parquet") and f not in taken]
        return checkpoint, taken, files

    def _rows(self, checkpoint: str | None, files: list[str]) -> DataFrame:
        paths = [f"{self.folder}/{f}" for f in files] + ([f"{checkpoint}/rows"] if checkpoint else [])
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self) -> DataFrame:
        checkpoint, _, files = self._state()
        return self._rows(checkpoint, files)

    def append(self, entries: DataFrame) -> None:
        """Append rows in one file, so that they become valid together."""
        entries.coalesce(1).write.mode("append").parquet(self.folder)
        checkpoint, taken, files = self._state()
        if len(files) > self.tail:
            self._write_checkpoint(checkpoint, taken, files)

    def _write_checkpoint(self, before: str | None, taken: set[str], files: list[str]) -> None:
        number = int(before.rsplit("/", 1)[1].split("-")[0]) + 1 if before else 1
        place = f"{self._checkpoints}/{number:012d}-{uuid.uuid4().hex}"
        self._rows(before, files).coalesce(1).write.parquet(f"{place}/rows")
        names = self.spark.createDataFrame([(f,) for f in files], "name STRING")
        names.coalesce(1).write.parquet(f"{place}/{_NAMES}")
        for name in taken:
            store.remove(self.spark, f"{self.folder}/{name}")
        for name in store.listing(self.spark, self._checkpoints):
            if before and name < before.rsplit("/", 1)[1]:
                store.remove(self.spark, f"{self._checkpoints}/{name}")
