"""Raw layer: namespaces, typed tables, literal rows.

``load_raw_tables`` is the setup step: create the ``raw`` and ``analytics``
namespaces and write the three typed raw tables (customers, products,
orders) from any :class:`Shop` binding, conforming each frame to its
declared schema. ``frames_from_rows`` builds a :class:`Shop` from inline
rows (``INSERT INTO ... VALUES``) for fixtures.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.plans.sink import save_table
from cartwheel.sources.schemas import RAW_TABLES
from cartwheel.sources.tables import Shop, from_catalog


def create_namespaces(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


@contextmanager
def namespace(spark: SparkSession, db: str) -> Iterator[str]:
    """Make ``db`` the current namespace, in which SQL text finds unqualified
    names, and go back to the one before; yields that one's name."""
    before = spark.catalog.currentDatabase()
    create_namespaces(spark, db)
    spark.catalog.setCurrentDatabase(db)
    try:
        yield before
    finally:
        spark.catalog.setCurrentDatabase(before)


def save_rows(spark: SparkSession, table: str, schema: T.StructType | str, rows: Iterable[Sequence]) -> DataFrame:
    """Literal rows as a typed catalog table (overwritten); returns it."""
    save_table(spark.createDataFrame(list(rows), schema).coalesce(1), table)
    return spark.table(table)


def save_shop_rows(spark: SparkSession, db: str, customers: Iterable[Sequence], products: Iterable[Sequence], orders: Iterable[Sequence]) -> Shop:
    """The raw layer from literal rows, in the column order of the schemas."""
    create_namespaces(spark, db)
    for name, rows in (("customers", customers), ("products", products), ("orders", orders)):
        save_rows(spark, f"{db}.{name}", RAW_TABLES[name], rows)
    return from_catalog(spark, db)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types;
    columns the source lacks become typed NULLs."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


# customer-grain work dominates the reports, so orders and customers are
# bucketed on the customer key; products stay unbucketed (a catalogue is
# normally small enough to broadcast)
BUCKET_KEYS = {"customers": "customer_id", "orders": "customer_id"}


def load_raw_tables(spark: SparkSession, shop: Shop, raw_db: str = "raw",
                    analytics_db: str = "analytics", buckets: int = 0) -> Shop:
    """Write the typed raw tables from ``shop``; returns the catalog binding.

    ``buckets`` > 0 writes orders and customers bucketed (and sorted) by
    customer_id into that many buckets. Every per-customer aggregate and the
    customer join then read co-located data: no exchange of the fact on the
    customer key. Choose the count for the data (about one bucket per
    128-256 MB of the orders table) and keep it fixed."""
    create_namespaces(spark, raw_db, analytics_db)
    for name, schema in RAW_TABLES.items():
        key = BUCKET_KEYS.get(name) if buckets > 0 else None
        save_table(conform(getattr(shop, name), schema), f"{raw_db}.{name}",
                   bucket_by=key, buckets=buckets)
    return from_catalog(spark, raw_db)


def frames_from_rows(spark: SparkSession, customers: Iterable[Sequence],
                     products: Iterable[Sequence], orders: Iterable[Sequence]) -> Shop:
    """Typed frames from literal rows, in the column order of the schemas."""
    return Shop(*(spark.createDataFrame(list(rows), RAW_TABLES[name])
                  for name, rows in (("customers", customers), ("products", products),
                                     ("orders", orders))))
