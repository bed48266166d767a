"""Additive schema evolution: rows written under an older layout, read under a newer one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows under this schema: columns they do not have are NULL, types are its own.

    Columns that the schema does not have are left out.
    """
    there = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
