"""Delimited files as text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopstar.operators.ingest import DELIMITED, text_schema
from shopstar.schemas import SourceTable


def read_delimited(spark: SparkSession, path: str, table: SourceTable) -> DataFrame:
    """Columns by position under a header line, all as text; an empty cell is NULL.

    Without quoting and with a fixed line end, Spark splits large files over tasks.
    """
    reader = spark.read.schema(text_schema(table)).options(**DELIMITED)
    return reader.options(header=True, enforceSchema=True, lineSep="\n").csv(path)
