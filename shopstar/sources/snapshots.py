"""Stored tables: every load writes a new folder, the run log names the valid one.

A table cannot be overwritten while it is read, and a half-written one must never be
seen. So a load writes beside the old snapshot and then appends its log row; readers
take the location of the newest successful row. A failed load leaves no trace but its
log row.

A snapshot may consist of several folders, which the log row lists: those that the load
wrote, and folders of earlier loads whose rows have not changed since. Folders never change.

A running number need not be stored with the rows. Its column is the row's place in its file
plus the rows in the files before, of which a small table is kept beside the snapshot.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from shopstar.functions import timestamp_lit
from shopstar.operators.keys import running_start
from shopstar.operators.quality import SUCCESS
from shopstar.schemas import LOGS, SOURCES
from shopstar.session import one_row
from shopstar.sources import store
from shopstar.sources.runlog import TAIL, RunLog
from shopstar.sources.scratch import Scratch

LOAD = "load"
_OFFSETS = "_identity"


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _file_in(location: str) -> Column:
    """Path of the file a row is read from, below the snapshot's folder."""
    return F.substring_index(F.col("_metadata.file_path"), f"/{location.rsplit('/', 1)[1]}/", -1)


def _offsets(location: str) -> str:
    """Where the rows before each file of a snapshot are noted."""
    table, load = location.rsplit("/", 1)
    return f"{table}{_OFFSETS}/{load}"


def numbered(spark: SparkSession, location: str, name: str) -> DataFrame:
    """A snapshot written with `numbered`, and `name`: 1, 2, ... in the order of its files."""
    rows = spark.read.parquet(location)
    placed = rows.select("*", _file_in(location).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = spark.read.parquet(_offsets(location))
    number = (F.col("_before") + F.col("_row") + 1).alias(name)
    return placed.join(before, "_file", "left").select(number, *rows.columns)


class Layer:
    """What the run log of one layer says at one moment: a row per table."""

    def __init__(self, spark: SparkSession, log: DataFrame, layouts: dict[str, list[str]] | None = None):
        """layouts: the columns of those tables whose files have further ones."""
        self.spark = spark
        self._layouts = layouts or {}
        newest = F.struct("load_end_time", "load_start_time")
        valid = F.when(F.col("status") == SUCCESS, newest)
        named = [c for c in ("location", "parts", "top_key", "identity") if c in log.columns]
        per_table = log.groupBy("table_name").agg(
            F.max_by("status", newest).alias("status"),
            F.max_by(F.struct(*named), valid).alias("valid"),
        )
        self._status = {}
        self._valid = {}
        for row in per_table.collect():
            self._status[row.table_name] = row.status
            if row.valid and row.valid.location:
                self._valid[row.table_name] = row.valid.asDict()

    def locations(self) -> list[str]:
        return [place for table in self._valid for place in self.folders(table)]

    def folders(self, table: str) -> list[str]:
        """The folders that the valid snapshot consists of; none if there is no snapshot."""
        found = self._valid.get(table)
        return (found.get("parts") or [found["location"]]) if found else []

    def top_key(self, table: str) -> int | None:
        """The largest surrogate key given so far, if the load noted it."""
        return self._valid.get(table, {}).get("top_key")

    def status(self, table: str) -> str | None:
        """Outcome of the last load of the table."""
        return self._status.get(table)

    def __getitem__(self, table: str) -> DataFrame:
        """The newest valid snapshot."""
        rows = self.get(table)
        if rows is None:
            raise LookupError(f"{table} has not been loaded")
        return rows

    def get(self, table: str) -> DataFrame | None:
        """The newest valid snapshot with its running number, if it has one."""
        found = self._valid.get(table)
        name = found.get("identity") if found else None
        if not name:
            return self.bare(table) if found else None
        return numbered(self.spark, found["location"], name)

    def bare(self, table: str) -> DataFrame:
        """The newest valid snapshot as it is stored, without a running number."""
        if table not in self._valid:
            raise LookupError(f"{table} has not been loaded")
        found = self._valid[table]
        parts = found.get("parts")
        rows = read_parts(self.spark, parts) if parts else self.spark.read.parquet(found["location"])
        return rows.select(*self._layouts.get(table, "*"))


def read_parts(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Rows of folders `<table>/load=<id>/<flag>=<true or false>`, under the layout of the first.

    A filter on the flag leaves out folders.
    """
    table = folders[0].rsplit(f"/{LOAD}=", 1)[0]
    flag = folders[0].rsplit("/", 1)[1].split("=")[0]
    named = [StructField(LOAD, StringType()), StructField(flag, BooleanType())]
    layout = StructType([*spark.read.parquet(folders[0]).schema, *named])
    return spark.read.schema(layout).option("basePath", table).parquet(*folders).drop(LOAD)


class Lake:
    """A root folder with one subfolder per layer and table."""

    def __init__(self, spark: SparkSession, root: str, tail: int = TAIL):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tail = tail

    def _runlog(self, layer: str) -> RunLog:
        return RunLog(self.spark, f"{self.root}/{layer}/metadata", LOGS[layer], self.tail)

    def log(self, layer: str) -> DataFrame:
        return self._runlog(layer).rows()

    def append_log(self, layer: str, *records: dict) -> None:
        """Append rows that become valid together."""
        fields = StructType.fromDDL(LOGS[layer]).fields
        rows = [
            one_row(self.spark).select(*[self._value(record.get(f.name), f) for f in fields])
            for record in records
        ]
        self._runlog(layer).append(reduce(DataFrame.unionByName, rows))

    @staticmethod
    def _value(value, field: StructField) -> Column:
        literal = timestamp_lit(value) if isinstance(value, datetime) else F.lit(value)
        return literal.cast(field.dataType).alias(field.name)

    def layer(self, layer: str) -> Layer:
        """The valid snapshots of a layer, looked up once: later loads do not show."""
        layouts = {name: t.schema.fieldNames() for name, t in SOURCES.items()} if layer == "bronze" else None
        return Layer(self.spark, self.log(layer), layouts)

    def read(self, layer: str, table: str) -> DataFrame:
        return self.layer(layer)[table]

    def scratch(self) -> Scratch:
        """Intermediate tables beside the layers, gone when the block ends."""
        return Scratch(self.spark, f"{self.root}/_scratch")

    def write(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        counts: dict[str, Column] | None = None,
        by: str | None = None,
        numbered: bool = False,
    ) -> tuple[str, dict[str, int]]:
        """Write a new snapshot; give its location and the counts taken on the way.

        Columns that start with an underscore serve the counts and are not stored. `by`
        names a column with a folder for each value. `numbered` notes the rows before each
        file, so that the snapshot can be read with a running number.
        """
        location = f"{self.root}/{layer}/{table}/{LOAD}={uuid.uuid4().hex}"
        seen = Observation()
        measures = counts or {"rows": F.count(F.lit(1))}
        watched = rows.observe(seen, *[m.alias(name) for name, m in measures.items()])
        writer = watched.select(*[c for c in rows.columns if not c.startswith("_") or c == by]).write
        (writer.partitionBy(by) if by else writer).parquet(location)
        counted = {name: int(value or 0) for name, value in seen.get.items()}
        if numbered:
            self._note_offsets(location)
        return location, counted

    def _note_offsets(self, location: str) -> None:
        """Store how many rows the files before each file have, in the order of their tasks.

        Reads no column, only the counts in the files. The driver gets a number per task.
        """
        task = F.regexp_extract("_file", r"part-(\d+)", 1).cast("int")
        files = self.spark.read.parquet(location).select(_file_in(location).alias("_file"))
        files = files.groupBy("_file").agg(F.count("*").alias("_rows")).withColumn("_task", task)
        counts = {r["_task"]: r["n"] for r in files.groupBy("_task").agg(F.sum("_rows").alias("n")).collect()}
        starts = list(accumulate((counts.get(t, 0) for t in range(max(counts, default=0))), initial=0))
        start = F.element_at(F.from_json(F.lit(json.dumps(starts)), "array<bigint>"), F.col("_task") + 1)
        before = (start + running_start(["_task"], "_file", "_rows")).alias("_before")
        files.select("_file", before).write.parquet(_offsets(location))

    def vacuum(
        self, layer: str, keep: int = 2, superseded_before: datetime | None = None, unnamed_before: datetime | None = None
    ) -> list[str]:
        """Remove folders that no kept snapshot consists of; returns what was removed.

        Kept are the `keep` newest snapshots of every table and all that were superseded
        since `superseded_before` (the present moment unless given), with every folder they
        list. A folder that no log row names may belong to a load that is still running: it
        goes only if it was last written to before `unnamed_before`. Lines set aside as
        malformed stay.
        """
        if keep < 1:
            raise ValueError("the valid snapshots cannot be removed")
        cut = superseded_before or now()
        kept, named = set(), set()
        by_table: dict[str, list[dict]] = {}
        for row in self.log(layer).collect():
            found = row.asDict()
            if found.get("rejected_location"):
                kept.add(found["rejected_location"])
            if found["location"] and found["status"] == SUCCESS:
                by_table.setdefault(found["table_name"], []).append(found)
        for rows in by_table.values():
            rows.sort(key=lambda r: (r["load_end_time"], r["load_start_time"]), reverse=True)
            for i, row in enumerate(rows):
                named.add(row["location"])
                if i < keep or rows[i - 1]["load_end_time"] >= cut:
                    kept.update((row["location"], *(row.get("parts") or ())))
        removed = []
        for table in store.listing(self.spark, f"{self.root}/{layer}"):
            for load in store.listing(self.spark, f"{self.root}/{layer}/{table}"):
                if load.startswith(f"{LOAD}="):
                    place = f"{self.root}/{layer}/{table}/{load}"
                    removed += self._unneeded(place, table, kept, named, unnamed_before)
        for path in removed:
            store.remove(self.spark, path)
        return removed

    def _unneeded(self, place: str, table: str, kept: set[str], named: set[str], unnamed_before) -> list[str]:
        """What of the folder of one load can go: all, some of its parts, or nothing."""
        if table.endswith(_OFFSETS):
            rows = place.replace(f"/{table}/", f"/{table.removesuffix(_OFFSETS)}/")
            return [] if rows in kept or rows not in named else [place]
        inside = [f"{place}/{part}" for part in store.listing(self.spark, place)]
        if place in kept:
            return []
        if not named & {place, *inside} and not (unnamed_before and store.changed(self.spark, place) < unnamed_before):
            return []
        gone = [path for path in inside if path not in kept]
        return gone if len(gone) < len(inside) else [place]
