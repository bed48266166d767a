"""Dimension maintenance: in-place (type 1) and versioned (type 2) upserts.

Spark tables on Parquet have no MERGE, so each upsert is a function from the stored
snapshot and the cleaned source to the next snapshot. Live rows and source meet in one
full outer join on the business key, out of which each key gives the row that stays, the row
that is added, or both. Closed versions never take part in it, so the cost follows the live
rows. Keys are unique on both sides, so no join key can be hot.

Which keys get a new row is found beforehand, from the keys and the attributes that open a
version alone; these keys are numbered and stored (`keep`), and nothing else is.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopstar.functions import timestamp_lit
from shopstar.operators.keys import Keep, key_map, next_key
from shopstar.session import one_row
from shopstar.sources.scratch import stored

INSERT, NEW_VERSION, OVERWRITE, UNCHANGED, CLOSED = (
    "INSERT",
    "SCD2_UPDATE",
    "TYPE1_UPDATE",
    "NO_CHANGE",
    "DELETED",
)
_STAMPS = ("source_created_at", "source_updated_at")
_STAMP_DDL = (
    "source_created_at TIMESTAMP_NTZ, source_updated_at TIMESTAMP_NTZ, "
    "dwh_load_date TIMESTAMP_NTZ, dwh_batch_id STRING"
)
_VERSION_DDL = "valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, is_current BOOLEAN, "


@dataclass(frozen=True)
class Compare:
    """How one attribute is compared.

    `absent` stands in for NULL on both sides; without it a NULL on either side means
    "no change seen", as a plain inequality does.
    """

    column: str
    absent: object = None

    def differs(self, old: Column, new: Column, collation: str | None) -> Column:
        if self.absent is not None:
            stand_in = F.lit(self.absent)
            old, new = F.coalesce(old, stand_in), F.coalesce(new, stand_in)
        if collation:
            old, new = F.collate(old, collation), F.collate(new, collation)
        return F.coalesce(old != new, F.lit(False))


@dataclass(frozen=True)
class Dimension:
    """A maintained dimension.

    Type 1: `overwrites` trigger an update that copies `carried` (all attributes).
    Type 2: `versions` open a new version; otherwise `overwrites` are changed in place.
    """

    name: str
    key: str
    skey: str
    attributes: str
    overwrites: tuple[Compare, ...]
    versions: tuple[Compare, ...] = ()
    in_place: tuple[str, ...] = ()
    textual: frozenset[str] = field(default_factory=frozenset)

    @property
    def versioned(self) -> bool:
        return bool(self.versions)

    @cached_property
    def schema(self) -> StructType:
        history = _VERSION_DDL if self.versioned else ""
        return StructType.fromDDL(
            f"{self.skey} BIGINT, {self.key} BIGINT, {self.attributes}, {history}{_STAMP_DDL}"
        )

    @cached_property
    def attribute_names(self) -> list[str]:
        return StructType.fromDDL(self.attributes).fieldNames()

    def any_differs(self, compares, old, new, collation: str | None) -> Column:
        changed = F.lit(False)
        for c in compares:
            rule = collation if c.column in self.textual else None
            changed = changed | c.differs(old(c.column), new(c.column), rule)
        return changed


ADDRESSES = Dimension(
    name="addresses",
    key="address_id",
    skey="address_skey",
    attributes="country STRING, city STRING, street STRING, postal_code STRING",
    overwrites=tuple(Compare(c, "") for c in ("country", "city", "street", "postal_code")),
    textual=frozenset({"country", "city", "street", "postal_code"}),
)
BRANDS = Dimension(
    name="brands",
    key="brand_id",
    skey="brand_skey",
    attributes="brand_name STRING",
    overwrites=(Compare("brand_name", ""),),
    textual=frozenset({"brand_name"}),
)
CATEGORIES = Dimension(
    name="categories",
    key="category_id",
    skey="category_skey",
    attributes="category_name STRING, parent_category_id BIGINT",
    overwrites=(Compare("category_name", ""),),
    textual=frozenset({"category_name"}),
)
PAYMENT_METHODS = Dimension(
    name="payment_methods",
    key="payment_method_id",
    skey="payment_method_skey",
    attributes="payment_method_name STRING, is_active BOOLEAN",
    overwrites=(Compare("payment_method_name", ""),),
    textual=frozenset({"payment_method_name"}),
)
CUSTOMERS = Dimension(
    name="customers",
    key="customer_id",
    skey="customer_skey",
    attributes=(
        "first_name STRING, last_name STRING, email STRING, date_of_birth DATE, "
        "gender STRING, join_date DATE, address_id BIGINT"
    ),
    versions=(Compare("address_id", -1),),
    overwrites=(
        Compare("first_name"),
        Compare("last_name"),
        Compare("email"),
        Compare("date_of_birth", "1900-01-01"),
        Compare("gender"),
    ),
    in_place=("first_name", "last_name", "email", "date_of_birth", "gender"),
    textual=frozenset({"first_name", "last_name", "email", "gender"}),
)
PRODUCTS = Dimension(
    name="products",
    key="product_id",
    skey="product_skey",
    attributes=(
        "product_name STRING, description STRING, category_id BIGINT, brand_id BIGINT, "
        "list_price DECIMAL(18,2)"
    ),
    versions=(Compare("list_price"),),
    overwrites=(
        Compare("product_name"),
        Compare("description"),
        Compare("category_id", -1),
        Compare("brand_id", -1),
    ),
    in_place=("product_name", "description", "category_id", "brand_id"),
    textual=frozenset({"product_name", "description"}),
)
DIMENSIONS = {
    d.name: d for d in (ADDRESSES, BRANDS, CATEGORIES, CUSTOMERS, PAYMENT_METHODS, PRODUCTS)
}


def empty(spark: SparkSession, dim: Dimension) -> DataFrame:
    """The snapshot before the first load; the optimizer sees that it has no rows."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema]
    return one_row(spark).select(*columns).filter(F.lit(False))


def _conform(rows: DataFrame, dim: Dimension) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in dim.schema])


def _incoming(source: DataFrame, dim: Dimension, columns: list[str]) -> DataFrame:
    """Source columns under a prefix, with a flag that tells a miss from a NULL."""
    renamed = [F.col(c).alias("s_" + c) for c in columns]
    return source.select(F.col(dim.key).alias("s_key"), *renamed, F.lit(True).alias("s_hit"))


def current_versions(snapshot: DataFrame) -> DataFrame:
    return snapshot.filter("is_current")


def _new_keys(live: DataFrame, source: DataFrame, dim: Dimension, first: Column, collation: str | None, keep: Keep) -> DataFrame:
    """Surrogate keys for the source keys that get a row: unknown ones, and new versions."""
    compared = [c.column for c in dim.versions]
    known = live.select(F.col(dim.key).alias("t_key"), *[F.col(c).alias("t_" + c) for c in compared])
    found = source.select(dim.key, *compared).join(known, F.col(dim.key) == F.col("t_key"), "left")
    opens = dim.any_differs(dim.versions, lambda c: F.col("t_" + c), F.col, collation)
    return key_map(found.filter(F.col("t_key").isNull() | opens), dim.key, "s_skey", first, keep)


def _matched(
    live: DataFrame, source: DataFrame, dim: Dimension, missing: str, first: Column, collation: str | None, keep: Keep
) -> DataFrame:
    """Live rows and source side by side with what is to happen, one row per key."""
    numbers = _new_keys(live, source, dim, first, collation, keep).withColumnRenamed(dim.key, "s_key")
    new = lambda c: F.col("s_" + c)
    change = (
        F.when(F.col("t_hit").isNull(), INSERT)
        .when(F.col("s_hit").isNull(), missing)
        .when(dim.any_differs(dim.versions, F.col, new, collation), NEW_VERSION)
        .when(dim.any_differs(dim.overwrites, F.col, new, collation), OVERWRITE)
        .otherwise(UNCHANGED)
    )
    # The numbers join the source on its key, so that the source is dealt out once for both.
    incoming = _incoming(source, dim, [*dim.attribute_names, *_STAMPS]).join(numbers, "s_key", "left")
    stored_rows = live.withColumn("t_hit", F.lit(True))
    joined = stored_rows.join(incoming, F.col(dim.key) == F.col("s_key"), "full_outer")
    return joined.withColumn("_change", change)


def _stay_and_open(matched: DataFrame, dim: Dimension, stays: dict[str, Column], opens: dict[str, Column]) -> DataFrame:
    """The rows that each matched key gives, in one pass over the join.

    stays: what becomes of a stored row's columns; opens: the columns of a new row that are
    not the source's.
    """
    opens = {dim.skey: F.col("s_skey"), dim.key: F.col("s_key")} | opens

    def row(values: dict[str, Column], change: Column) -> Column:
        cells = [values[f.name].cast(f.dataType).alias(f.name) for f in dim.schema]
        return F.struct(*cells, change.alias("_change"))

    old = {f.name: stays.get(f.name, F.col(f.name)) for f in dim.schema}
    new = {f.name: opens.get(f.name, F.col("s_" + f.name) if f.name in (*dim.attribute_names, *_STAMPS) else None) for f in dim.schema}
    change = F.col("_change")
    rows = F.array(
        F.when(change != INSERT, row(old, change)),
        F.when(change.isin(INSERT, NEW_VERSION), row(new, F.lit(INSERT))),
    )
    return matched.select(F.inline(F.array_compact(rows)))


def scd1_apply(
    target: DataFrame,
    source: DataFrame,
    dim: Dimension,
    batch_id: str,
    as_of,
    collation: str | None = None,
    tag: bool = False,
    keep: Keep = stored,
) -> DataFrame:
    """Next snapshot of an in-place dimension; rows missing from the source stay.

    With `tag`, a `_change` column (INSERT, TYPE1_UPDATE or NO_CHANGE) is kept so that
    the writer can count changes while it writes.
    """
    matched = _matched(target, source, dim, UNCHANGED, next_key(target, dim.skey), collation, keep)
    stamp = {"dwh_load_date": timestamp_lit(as_of), "dwh_batch_id": F.lit(batch_id)}
    news = {c: F.col("s_" + c) for c in (*dim.attribute_names, *_STAMPS)} | stamp
    overwritten = F.col("_change") == OVERWRITE
    stays = {c: F.when(overwritten, value).otherwise(F.col(c)) for c, value in news.items()}
    both = _stay_and_open(matched, dim, stays, stamp)
    return both if tag else both.drop("_change")


def scd2_classify(
    target: DataFrame, source: DataFrame, dim: Dimension, collation: str | None = None
) -> DataFrame:
    """The source with `change_type` against the current version; first rule that fits wins."""
    compared = [c.column for c in (*dim.versions, *dim.overwrites)]
    live = current_versions(target).select(
        F.col(dim.key).alias("t_key"),
        *[F.col(c).alias("t_" + c) for c in compared],
        F.lit(True).alias("t_hit"),
    )
    old = lambda c: F.col("t_" + c)
    change = (
        F.when(F.col("t_hit").isNull(), INSERT)
        .when(dim.any_differs(dim.versions, old, F.col, collation), NEW_VERSION)
        .when(dim.any_differs(dim.overwrites, old, F.col, collation), OVERWRITE)
        .otherwise(UNCHANGED)
    )
    return (
        source.join(live, F.col(dim.key) == F.col("t_key"), "left")
        .withColumn("change_type", change)
        .select(
            *source.columns,
            *[old(c.column).alias(f"old_{c.column}") for c in dim.versions],
            "change_type",
        )
    )


def deleted_keys(target: DataFrame, source: DataFrame, dim: Dimension) -> DataFrame:
    """Current versions whose key the source no longer has."""
    return current_versions(target).join(source.select(dim.key), dim.key, "left_anti")


def scd2_next(
    live: DataFrame,
    source: DataFrame,
    dim: Dimension,
    batch_id: str,
    as_of,
    first: Column,
    collation: str | None = None,
    keep: Keep = stored,
) -> DataFrame:
    """What a load makes of the current versions: those kept, changed and ended, and new ones.

    A current version is kept, overwritten in place, or ended (a new version follows, or
    the source dropped the key). A key that was closed and comes back has no current
    version, so it is an insert. New rows are numbered from `first` on. `_change` says what
    happened to each row; the old half of a new version is tagged SCD2_UPDATE and its new
    half INSERT.
    """
    now = timestamp_lit(as_of)
    matched = _matched(live, source, dim, CLOSED, first, collation, keep)
    overwritten = F.col("_change") == OVERWRITE
    ended = F.col("_change").isin(CLOSED, NEW_VERSION)
    loaded = {"dwh_load_date": now, "dwh_batch_id": F.lit(batch_id)}
    news = {c: F.col("s_" + c) for c in (*dim.in_place, "source_updated_at")} | loaded
    stays = {c: F.when(overwritten, value).otherwise(F.col(c)) for c, value in news.items()}
    stays |= {"valid_to": F.when(ended, now).otherwise(F.col("valid_to")), "is_current": ~ended}
    opens = loaded | {"valid_from": now, "valid_to": F.lit(None), "is_current": F.lit(True)}
    return _stay_and_open(matched, dim, stays, opens)


def scd2_apply(
    target: DataFrame,
    source: DataFrame,
    dim: Dimension,
    batch_id: str,
    as_of,
    collation: str | None = None,
    tag: bool = False,
    keep: Keep = stored,
) -> DataFrame:
    """Next snapshot of a versioned dimension, its closed versions included.

    With `tag`, `_change` is kept; see `scd2_next`.
    """
    live, first = current_versions(target), next_key(target, dim.skey)
    changed = scd2_next(live, source, dim, batch_id, as_of, first, collation, keep)
    history = _conform(target.filter("not is_current"), dim).withColumn("_change", F.lit(UNCHANGED))
    snapshot = history.unionByName(changed)
    return snapshot if tag else snapshot.drop("_change")


def change_counts(
    target: DataFrame, source: DataFrame, dim: Dimension, collation: str | None = None
) -> DataFrame:
    """Rows per change type, including the keys that the source dropped."""
    seen = scd2_classify(target, source, dim, collation).select("change_type")
    gone = deleted_keys(target, source, dim).select(F.lit(CLOSED).alias("change_type"))
    return seen.unionByName(gone).groupBy("change_type").agg(F.count("*").alias("keys"))
