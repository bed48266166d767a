"""Intermediate tables that survive the loss of executors."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from shopstar.session import CHECKPOINT_DIR
from shopstar.sources.store import remove


def shared_folder(spark: SparkSession) -> str:
    """The folder, reached by all executors, that the session names."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors reach")
    return folder.rstrip("/")


class Scratch:
    """Tables written under one folder, which leaving the `with` block removes.

    A kept table cuts the lineage like a checkpoint, and unlike one lets later steps read
    single columns and see the real size. Results that are read later must be written
    elsewhere before the block ends.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.path = f"{folder or shared_folder(spark)}/shopstar/{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}

    def keep(self, rows: DataFrame, by: str | None = None) -> DataFrame:
        """The same rows, written once and read back; `by`: with a folder for each value."""
        path = f"{self.path}/{uuid.uuid4().hex}"
        (rows.write.partitionBy(by) if by else rows.write).parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        self._paths[id(kept)] = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Remove a table that is not read any more."""
        remove(self.spark, self._paths.pop(id(kept)))

    def close(self) -> None:
        remove(self.spark, self.path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        self.close()


_left: list[tuple[object, object]] = []


def session_folder(spark: SparkSession) -> str:
    """A new folder, under the shared one, that is removed when this driver program ends."""
    path = f"{shared_folder(spark)}/shopstar/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    _left.append((place.getFileSystem(spark._jsc.hadoopConfiguration()), place))
    return path


def stored(rows: DataFrame, by: str | None = None) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    They stay as long as this driver program, since whatever is derived from them is read
    later.
    """
    path = session_folder(rows.sparkSession)
    return Scratch(rows.sparkSession, path).keep(rows, by)


@atexit.register
def remove_stored() -> None:
    """Remove the folders that were to last as long as the program."""
    while _left:
        store, place = _left.pop()
        # The JVM may be gone before the program is; then the folder's owner has to tidy up.
        with contextlib.suppress(Exception):
            store.delete(place, True)
