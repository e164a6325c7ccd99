"""Rerun-safe overwrite of a catalog table.

``save_table`` gives ``df.write.mode("overwrite").saveAsTable(t)``
semantics (the table afterwards holds exactly ``df``, with ``df``'s
schema) but never deletes the live data before the new data is complete:

1. the frame is written to a fresh version directory under the shared
   output root (Spark's commit protocol retries lost tasks; a failed job
   leaves only an unpublished directory behind);
2. only after that job commits is the table pointed at the new directory.

With an unchanged schema and bucket layout that is one catalog call, and
readers see the old version or the new one. A changed schema or layout drops
the table entry and creates it anew; between the two calls the table does not
exist. The version published before the live one is kept for readers still on
it and removed by the next save (the table remembers it). Directories that were
never published are left alone: another writer may still be filling them.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartwheel.config import SAVED_STATUS
from cartwheel.session import ensure_checkpoint_dir, output_root

PREVIOUS = "cartwheel.previous"  # table property: the version published before


@dataclass(frozen=True)
class Live:
    location: str
    schema: T.StructType
    buckets: tuple[str, str] | None
    previous: str | None


def _split(table: str) -> tuple[str, str]:
    db, _, name = table.rpartition(".")
    if not db:
        raise ValueError(f"qualify the table with its database: {table!r}")
    return db, name


def published(spark: SparkSession, table: str) -> Live | None:
    """What the catalog has of a table; None if there is none."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    n = told.get("Num Buckets")
    return Live(told["Location"], spark.table(table).schema,
                (n, told.get("Bucket Columns", "")) if n else None, props.get(PREVIOUS))


def save_table(df: DataFrame, table: str, root: str | None = None,
               bucket_by: str | None = None, buckets: int = 0) -> str:
    """Overwrite ``db.table`` with ``df``; returns the published location.

    With ``bucket_by``/``buckets`` the table is hash-bucketed (and sorted) on
    that column, so joins and aggregations on it between tables bucketed
    alike need no exchange."""
    spark: SparkSession = df.sparkSession
    db, name = _split(table)
    base = (root or output_root(spark)).rstrip("/")
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    location = f"{base}/{db}.db/{name}/{version}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    staging = f"{db}.{name}__{version.replace('-', '_')}"
    try:
        if bucket_by:  # a bucketed layout is written through a catalog entry
            (df.write.format("parquet").mode("errorifexists").option("path", location)
               .bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(staging))
        else:
            df.write.mode("errorifexists").parquet(location)
            # parquet stores every column as nullable: declare the table that way
            schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
            spark.catalog.createTable(staging, path=location, source="parquet", schema=schema)
        live, new = published(spark, table), published(spark, staging)
        if live and (live.schema, live.buckets) == (new.schema, new.buckets):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.sql(f"REFRESH TABLE {table}")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        if live:
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{live.location}')")
    finally:  # no staging entry stays behind (its data is external)
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    if live and live.previous:
        remove_path(spark, live.previous)
    return location


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Cut lineage: write ``df`` as parquet under the cluster's
    ``spark.checkpoint.dir`` (shared storage) and return the re-read frame
    with its path. Columnar, compressed and read back vectorised, unlike
    row-serialised RDD checkpoint blocks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), path


def remove_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the session's Hadoop FileSystem."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def saved_row_count_status(spark: SparkSession, table: str) -> str:
    """Status line after a save: the count is read back from the table."""
    return SAVED_STATUS.format(rows=spark.table(table).count(), table=table)
