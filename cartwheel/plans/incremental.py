"""Incremental refresh of what the saved jobs are made from.

Both jobs derive from totals by customer and month. Those are kept as one part
per month (:mod:`cartwheel.plans.parts`), and a refresh brings them up to date
from the files that arrived since:

* the manifest holds a ledger of the processed files (path, size, time). New
  files are those of the landing folder that it lacks; only they are read;
* their lines meet catalogue and order heads and become a delta by customer and
  month. Sums and counts add up, so the parts of the delta's months, and no
  others, are summed with it and written anew. Distinct customers of a month
  need no sketch: a customer has one row in it;
* lines whose product or head has not arrived yet are kept and tried again with
  the next refresh, as a full rebuild would find them then;
* parts, ledger and waiting lines are published by one commit. A refresh that
  dies leaves all as it was and the next one reads the same files.

If a processed file is gone or is another one now, what it brought cannot be
taken back, and the totals are rebuilt from all files. Catalogue prices and
order dates are taken as they are when a line is first matched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.star import month_of
from cartwheel.plans.parts import PartTable
from cartwheel.plans.sink import materialize, remove_path
from cartwheel.session import output_root

FILE, WAITING = "file", "waiting"
TOTALS = "customer_id bigint, month date, revenue decimal(38,2), n_orders bigint, n_totals bigint"
LINES = "order_id bigint, product_id bigint, quantity int"
_PART = "part"


@dataclass(frozen=True)
class Refresh:
    files: int                # files read
    months: tuple[str, ...]   # parts written
    waiting: int              # lines without a product or head
    rebuilt: bool = False


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size, modified`` of the Parquet files under ``folder``; their
    content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true") \
                .load(folder).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


class CustomerMonths:
    """Totals by customer and month of the lines in ``landing`` (Parquet files
    with order_id, product_id, quantity)."""

    def __init__(self, spark: SparkSession, table: str, landing: str, root: str | None = None):
        self.spark, self.landing = spark, landing
        self.state = PartTable(spark, table, root)
        self.waiting_root = f"{(root or output_root(spark)).rstrip('/')}/{table.replace('.', '.db/')}__waiting"

    def totals(self) -> DataFrame:
        """The totals as of the last refresh."""
        have = self.state.read()
        return have if have is not None else self.spark.createDataFrame([], TOTALS)

    def refresh(self, products: DataFrame, heads: DataFrame) -> Refresh:
        """Brings the totals up to the files that are in ``landing`` now."""
        spark, state = self.spark, self.state
        present, path = materialize(list_files(spark, self.landing), "refresh-files")
        used = [path]
        try:
            ledger = state.manifest(FILE)
            lost = ledger.join(present, ["path", "size", "modified"], "left_anti").limit(1).count() > 0
            if lost:
                ledger = ledger.limit(0)
            # the files' names reach the driver, as they do for any scan
            new = present.join(ledger.select("path", "size", "modified"), ["path", "size", "modified"], "left_anti")
            files = [r["path"] for r in new.select("path").collect()]
            waiting = [] if lost else [r["path"] for r in state.manifest(WAITING).collect()]
            sources = [spark.read.schema(LINES).parquet(*part) for part in (files, waiting) if part]
            if not sources and state.began is not None and not lost:
                return Refresh(0, (), 0)
            lines = reduce(DataFrame.unionByName, sources) if sources else spark.createDataFrame([], LINES)
            delta, unmatched = self._match(lines, products, heads, used)
            left = unmatched.count()
            others = ledger.select("kind", "key", "path", "size", "modified").unionByName(
                new.select(F.lit(FILE).alias("kind"), F.lit(None).cast("string").alias("key"), "path", "size", "modified"))
            if left:
                kept = f"{self.waiting_root}/{uuid.uuid4().hex}"
                unmatched.write.mode("errorifexists").parquet(kept)
                others = others.unionByName(spark.createDataFrame([(WAITING, None, kept, None, None)], others.schema))
            months = {r[_PART] for r in delta.select(_PART).distinct().collect()}
            replaced = months | (set(state.parts()) if lost else set())
            old = None if lost else state.read(months)
            rows = delta.drop(_PART) if old is None else delta.drop(_PART).unionByName(old)
            rows = rows.groupBy("customer_id", "month").agg(*[F.sum(c).alias(c) for c in ("revenue", "n_orders", "n_totals")])
            state.commit(self._typed(rows).withColumn(_PART, self._part()), _PART, replaced, others)
            for path in waiting:
                remove_path(spark, path)
            return Refresh(len(files), tuple(sorted(months)), left, lost)
        finally:
            for path in used:
                remove_path(spark, path)

    @staticmethod
    def _part():
        return F.coalesce(F.date_format("month", "yyyy-MM"), F.lit("none"))

    @staticmethod
    def _typed(rows: DataFrame) -> DataFrame:
        return rows.select("customer_id", "month", F.col("revenue").cast("decimal(38,2)").alias("revenue"), "n_orders", "n_totals")

    def _match(self, lines: DataFrame, products: DataFrame, heads: DataFrame, used: list[str]) -> tuple[DataFrame, DataFrame]:
        """The delta by customer and month, and the lines that wait. Neither
        side is broadcast by hint; heads are merged as they grow with the fact."""
        p = products.select("product_id", "unit_price", F.lit(True).alias("priced"))
        h = heads.select("order_id", "customer_id", "order_date", F.lit(True).alias("headed")).hint("merge")
        met = lines.withColumn("line", F.monotonically_increasing_id()).join(p, "product_id", "left").join(h, "order_id", "left")
        met, path = materialize(met.select("line", "order_id", "product_id", "quantity", "customer_id", "order_date",
                                           (F.col("quantity") * F.col("unit_price")).alias("order_total"),
                                           (F.col("priced") & F.col("headed")).alias("matched")), "refresh-lines")
        used.append(path)
        delta = met.filter("matched").groupBy("customer_id", month_of().alias("month")).agg(
            F.sum("order_total").alias("revenue"), F.count("order_id").alias("n_orders"), F.count("order_total").alias("n_totals"))
        delta, path = materialize(self._typed(delta).withColumn(_PART, self._part()), "refresh-delta")
        used.append(path)
        # a null key never finds a partner: such a line waits for nothing; one with two partners on one side waits once
        unmatched = met.filter("matched is null and order_id is not null and product_id is not null").dropDuplicates(["line"])
        return delta, unmatched.select("order_id", "product_id", "quantity")
