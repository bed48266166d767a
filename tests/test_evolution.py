"""Rows of an older layout under a newer one."""

from __future__ import annotations

from pyspark.sql.types import StructType

from shopstar.operators.evolution import conform
from shopstar.queries import _evolved


def test_columns_are_added_cast_and_left_out(spark):
    rows = spark.createDataFrame([(1, "x", 2.5)], "a INT, gone STRING, b DOUBLE")
    schema = StructType.fromDDL("b DECIMAL(18,2), a BIGINT, added STRING")
    out = conform(rows, schema)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
    assert [str(v) for v in out.first()] == ["2.50", "1", "None"]


def test_undated_rows_stay(spark):
    shape = "order_id INT, date_key INT, discount_amount DOUBLE"
    sales = spark.createDataFrame([(1, 19970101, 1.0), (2, 19980101, 2.0), (3, None, 3.0)], shape)
    got = {r.order_id: r.discount_amount for r in _evolved(sales).collect()}
    assert got == {1: None, 2: 2.0, 3: None}
