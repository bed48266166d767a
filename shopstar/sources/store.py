"""Files and folders of whichever store a path lies in, by way of Spark's file systems."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing if it is not there."""
    place, store = _place(spark, path)
    store.delete(place, True)


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if it is not there."""
    place, store = _place(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def changed(spark: SparkSession, path: str) -> datetime:
    """When a file or folder was last written to, in UTC."""
    place, store = _place(spark, path)
    moment = store.getFileStatus(place).getModificationTime() / 1000
    return datetime.fromtimestamp(moment, timezone.utc).replace(tzinfo=None)
