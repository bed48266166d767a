"""Run a registered query and its SQL equivalent over the same tables and compare them."""

from __future__ import annotations

import glob
import math
import os

import duckdb

from shopstar.oracle import ORACLE
from shopstar.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    spelled = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(spelled, key=repr)


def both(spark, con, folder: str, key: str):
    frame = QUERIES[key](spark, folder)
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(ORACLE[key])
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    return ours, theirs
