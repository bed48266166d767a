"""Table layouts of the warehouse.

Layouts are fixed and never inferred. Keys are INT in files; operators also accept
wider or textual keys, since none of them depends on the key type.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql.types import StringType, StructField, StructType, VarcharType

AUDIT = "load_date TIMESTAMP_NTZ, batch_id VARCHAR(50)"
STAMPS = "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, " + AUDIT


@dataclass(frozen=True)
class SourceTable:
    """A raw table: its primary key and its column list in file order."""

    name: str
    key: str
    ddl: str

    @cached_property
    def declared(self) -> StructType:
        """The layout with text lengths; parsed by the running Spark session."""
        return StructType.fromDDL(self.ddl)

    @cached_property
    def schema(self) -> StructType:
        return StructType(
            [
                StructField(f.name, StringType(), f.nullable)
                if isinstance(f.dataType, VarcharType)
                else f
                for f in self.declared
            ]
        )

    @cached_property
    def lengths(self) -> dict[str, int]:
        """Longest text that each text column takes."""
        return {
            f.name: f.dataType.length
            for f in self.declared
            if isinstance(f.dataType, VarcharType)
        }

    @cached_property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


# Source layouts, columns in file order.
_SOURCES = (
    SourceTable(
        "customers",
        "customer_id",
        "customer_id INT NOT NULL, first_name VARCHAR(100) NOT NULL, "
        "last_name VARCHAR(100) NOT NULL, email VARCHAR(255) NOT NULL, date_of_birth DATE, "
        "gender VARCHAR(20), join_date DATE NOT NULL, address_id INT, " + STAMPS,
    ),
    SourceTable(
        "addresses",
        "address_id",
        "address_id INT NOT NULL, country VARCHAR(100) NOT NULL, city VARCHAR(100) NOT NULL, "
        "street VARCHAR(255) NOT NULL, postal_code VARCHAR(20) NOT NULL, " + STAMPS,
    ),
    SourceTable(
        "brands", "brand_id", "brand_id INT NOT NULL, name VARCHAR(255) NOT NULL, " + STAMPS
    ),
    SourceTable(
        "categories",
        "category_id",
        "category_id INT NOT NULL, name VARCHAR(255) NOT NULL, parent_category_id INT, " + STAMPS,
    ),
    SourceTable(
        "products",
        "product_id",
        "product_id INT NOT NULL, name VARCHAR(255) NOT NULL, description VARCHAR(1000), "
        "category_id INT, brand_id INT, list_price DECIMAL(18,2), " + STAMPS,
    ),
    SourceTable(
        "payment_methods",
        "payment_method_id",
        "payment_method_id INT NOT NULL, payment_method_name VARCHAR(100) NOT NULL, "
        "is_active BOOLEAN NOT NULL, " + STAMPS,
    ),
    SourceTable(
        "orders",
        "order_id",
        "order_id INT NOT NULL, customer_id INT NOT NULL, order_date TIMESTAMP_NTZ NOT NULL, "
        "payment_method_id INT, session_id INT, order_status VARCHAR(50) NOT NULL, "
        "subtotal_amount DECIMAL(18,2) NOT NULL, discount_amount DECIMAL(18,2), "
        "tax_amount DECIMAL(18,2), shipping_amount DECIMAL(18,2), "
        "total_amount DECIMAL(18,2) NOT NULL, " + STAMPS,
    ),
    SourceTable(
        "order_items",
        "order_item_id",
        "order_item_id INT NOT NULL, order_id INT NOT NULL, product_id INT NOT NULL, "
        "quantity INT NOT NULL, unit_price DECIMAL(18,2) NOT NULL, "
        "discount_amount DECIMAL(18,2), tax_amount DECIMAL(18,2), " + STAMPS,
    ),
    SourceTable(
        "order_item_returns",
        "return_id",
        "return_id INT NOT NULL, order_item_id INT NOT NULL, "
        "return_date TIMESTAMP_NTZ NOT NULL, quantity_returned INT NOT NULL, "
        "refund_amount DECIMAL(18,2), reason VARCHAR(255), " + STAMPS,
    ),
    SourceTable(
        "website_sessions",
        "website_session_id",
        "website_session_id INT NOT NULL, created_at TIMESTAMP_NTZ NOT NULL, user_id INT, "
        "is_repeat_session BOOLEAN, utm_source VARCHAR(100), utm_campaign VARCHAR(100), "
        "utm_content VARCHAR(100), device_type VARCHAR(50), http_referer VARCHAR(255), " + AUDIT,
    ),
    SourceTable(
        "pageviews",
        "website_pageview_id",
        "website_pageview_id INT NOT NULL, created_at TIMESTAMP_NTZ NOT NULL, "
        "website_session_id INT NOT NULL, pageview_url VARCHAR(255), " + AUDIT,
    ),
)
SOURCES: dict[str, SourceTable] = {table.name: table for table in _SOURCES}

# Run logs, one layout per layer. `location` names the published snapshot, `parts` the folders
# it consists of where they are several, `top_key` the largest surrogate key given so far, and
# `identity` a running number that its rows have by their place in its files.
LOGS = {
    "bronze": (
        "table_name STRING NOT NULL, source_system STRING, load_start_time TIMESTAMP_NTZ, "
        "load_end_time TIMESTAMP_NTZ, last_load_date TIMESTAMP_NTZ NOT NULL, "
        "batch_id STRING NOT NULL, row_count BIGINT, status STRING NOT NULL, "
        "error_message STRING, comments STRING, created_at TIMESTAMP_NTZ NOT NULL, "
        "location STRING, rows_rejected BIGINT, rejected_location STRING"
    ),
    "silver": (
        "table_name STRING NOT NULL, source_layer STRING NOT NULL, "
        "load_start_time TIMESTAMP_NTZ, load_end_time TIMESTAMP_NTZ, "
        "silver_batch_id STRING NOT NULL, source_batch_id STRING, rows_inserted BIGINT, "
        "rows_updated BIGINT, rows_deleted BIGINT, scd_type STRING, status STRING NOT NULL, "
        "error_message STRING, created_at TIMESTAMP_NTZ NOT NULL, location STRING, "
        "parts ARRAY<STRING>, top_key BIGINT, identity STRING"
    ),
    "gold": (
        "table_name STRING, source_layer STRING NOT NULL, load_start_time TIMESTAMP_NTZ, "
        "load_end_time TIMESTAMP_NTZ, rows_inserted BIGINT, status STRING, "
        "error_message STRING, location STRING, identity STRING"
    ),
}
