"""A table kept as parts, of which a commit replaces only some.

Every part (a month, a hash bucket) is a directory of Parquet files. A small
manifest table says which directory is which part's, and holds what else must
change together with the parts, such as a ledger of processed files. A commit
writes the changed parts into directories of their own and then publishes a new
manifest with :func:`cartwheel.plans.sink.save_table`: one catalog call, so
readers see all of the commit or nothing, and a job that dies before leaves the
old state as it was. Directories that a commit replaces stay for readers that
are still on them and go with the next commit.

One writer at a time: a commit that finds another manifest than the one it
began with refuses.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.plans.sink import published, remove_path, save_table
from cartwheel.session import output_root

MANIFEST = "kind string, key string, path string, size bigint, modified timestamp"
PART, SCHEMA, REPLACED = "part", "schema", "replaced"
_DIR = "__part"


class ConcurrentCommit(RuntimeError):
    """Another writer has published a manifest meanwhile."""


class PartTable:
    """Parts by key (a string); their number is bounded by design (months,
    buckets), so the driver may hold it."""

    def __init__(self, spark: SparkSession, table: str, root: str | None = None):
        self.spark, self.table = spark, table
        db, _, name = table.rpartition(".")
        self.root = f"{(root or output_root(spark)).rstrip('/')}/{db}.db/{name}__parts"
        self.began = self._location()

    def _location(self) -> str | None:
        live = published(self.spark, self.table)
        return live.location if live else None

    def manifest(self, kind: str | None = None) -> DataFrame:
        if self.began is None:
            return self.spark.createDataFrame([], MANIFEST)
        rows = self.spark.read.schema(MANIFEST).parquet(self.began)
        return rows.filter(F.col("kind") == kind) if kind else rows

    def parts(self) -> dict[str, str]:
        return {r["key"]: r["path"] for r in self.manifest(PART).collect()}

    def schema(self) -> T.StructType | None:
        told = self.manifest(SCHEMA).first()
        return T.StructType.fromJson(json.loads(told["key"])) if told else None

    def read(self, keys=None) -> DataFrame | None:
        """Rows of all parts, or of those named; None before the first commit."""
        schema = self.schema()
        if schema is None:
            return None
        paths = [p for k, p in sorted(self.parts().items()) if keys is None or k in keys]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def drop(self) -> None:
        """Remove the table and all its directories."""
        live = published(self.spark, self.table)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        for path in (live.location if live else None, live.previous if live else None, self.root):
            if path:
                remove_path(self.spark, path)
        self.began = None

    def commit(self, rows: DataFrame, part: str, replaces, others: DataFrame | None = None) -> dict[str, str]:
        """``rows`` (its column ``part`` names each row's part) take the place
        of the parts ``replaces``, which must name all parts that rows has; a
        named part without rows goes. ``others`` are the manifest's rows of
        other kinds. Returns the new directories by part."""
        spark, replaces = self.spark, set(replaces)
        old = self.parts()
        fields = [f for f in rows.schema.fields if f.name != part]
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        told = self.schema()
        if told is not None and told != schema:
            raise ValueError(f"the table has the columns {told.simpleString()}, not {schema.simpleString()}")
        version = f"{self.root}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
        written: dict[str, str] = {}
        if replaces:
            # rebalanced: a large part is split over several files, small ones share a task
            (rows.withColumn(_DIR, F.hex(F.encode(F.col(part), "UTF-8"))).drop(part).hint("rebalance", _DIR)
                 .write.mode("errorifexists").partitionBy(_DIR).parquet(version))
            written = {bytes.fromhex(name.partition("=")[2]).decode(): f"{version}/{name}" for name in _folders(spark, version)}
        if not set(written) <= replaces:
            raise ValueError(f"rows of parts that are not replaced: {sorted(set(written) - replaces)}")
        entries = [(PART, k, p, None, None) for k, p in {**{k: p for k, p in old.items() if k not in replaces}, **written}.items()]
        entries += [(REPLACED, k, p, None, None) for k, p in old.items() if k in replaces]
        entries.append((SCHEMA, schema.json(), None, None, None))
        manifest = spark.createDataFrame(entries, MANIFEST).coalesce(1)
        if others is not None:
            manifest = manifest.unionByName(others.select("kind", "key", "path", "size", "modified"))
        done = [r["path"] for r in self.manifest(REPLACED).collect()]
        if self._location() != self.began:
            raise ConcurrentCommit(self.table)
        self.began = save_table(manifest, self.table)
        for path in done:
            remove_path(spark, path)
        return written


def _folders(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return [s.getPath().getName() for s in found if s.isDirectory() and s.getPath().getName().startswith(f"{_DIR}=")]
