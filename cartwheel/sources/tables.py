"""The three raw frames every operator works on.

:class:`Shop` holds lazy DataFrames with the raw-layer columns of
:mod:`cartwheel.sources.schemas`. They can come from

* the driver's TPC-H-like parquet files (:func:`from_testdata`), bound as
  described below, with no copy: Catalyst prunes columns and pushes filters
  into each parquet scan;
* catalog tables (:func:`from_catalog`), e.g. the ``raw`` layer written by
  :func:`cartwheel.sources.catalog.load_raw_tables`;
* literal rows (:func:`cartwheel.sources.catalog.frames_from_rows`).

Test-data binding (one ``orders`` row per order line):

==================  ==============================================
customers           customer ⨝ nation ⨝ region (inner)
  customer_id       c_custkey
  first_name        c_name
  last_name         c_mktsegment (stand-in: no surname column)
  region            r_name
products            part
  product_id        p_partkey
  product_name      p_name
  category          p_type
  unit_price        cast(p_retailprice as decimal(10,2))
orders              lineitem ⨝ orders on l_orderkey = o_orderkey
  order_id          l_orderkey
  customer_id       o_custkey
  product_id        l_partkey
  quantity          cast(l_quantity as int)
  order_date        cast(o_orderdate as date)
==================  ==============================================
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.schemas import MONEY, TESTDATA


@dataclass(frozen=True)
class Shop:
    """``orders`` has one row per order line. A source that stores orders in
    two tables also gives them apart, so that operators can price lines before
    the join and put customers on the (fewer) heads: ``lines`` (order_id,
    product_id, quantity) and ``heads`` (order_id, customer_id, order_date),
    with orders = lines ⨝ heads."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    lines: DataFrame | None = None
    heads: DataFrame | None = None

    def register_views(self, prefix: str = "shop_") -> None:
        """Expose the frames to SQL text as ``shop_customers`` etc. Without
        separate heads, ``shop_lines`` and ``shop_heads`` do not exist."""
        for name in ("customers", "products", "orders", "lines", "heads"):
            frame = getattr(self, name)
            if frame is not None:
                frame.createOrReplaceTempView(f"{prefix}{name}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TESTDATA:
        reader = reader.schema(TESTDATA[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class BoundShop(Shop):
    """The test tables as a shop. Each frame is bound when it is first used:
    a report that needs two columns of one table lists that table only."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        object.__setattr__(self, "_table", lambda name: read_table(spark, sf_dir, name))

    @cached_property
    def customers(self) -> DataFrame:
        # nation ⨝ region is bounded by the nation table: 25 rows, fixed by the
        # schema's design, not by the data volume. That proven bound is why it is
        # the one side broadcast by hint (the planner's own estimate for a join
        # multiplies the input sizes and would broadcast customer instead).
        # customer and part grow with the data: their join strategy is left to
        # the size-checked planner and AQE (broadcast only under the threshold).
        t = self._table
        geo = F.broadcast(t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")))
        return t("customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.col("r_name").alias("region"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_retailprice").cast(MONEY).alias("unit_price"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"))

    @cached_property
    def heads(self) -> DataFrame:
        return self._table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"))

    @cached_property
    def orders(self) -> DataFrame:
        # lineitem ⨝ orders is fact-to-fact: orders grows with the data and has
        # no size bound, so it is never broadcast. Sort-merge (not shuffled hash):
        # it spills, and AQE can split a skewed order key across tasks.
        return join_heads(self.lines, self.heads)


def from_testdata(spark: SparkSession, sf_dir: str) -> Shop:
    """Bind the parquet test tables to the raw-layer columns (lazy).

    Every call lists the files anew: a binding that outlived a call would miss
    files that arrive during the session."""
    return BoundShop(spark, sf_dir)


def join_heads(lines: DataFrame, heads: DataFrame) -> DataFrame:
    """lines ⨝ heads on order_id, all columns (order_id once)."""
    keep = [heads[c] for c in heads.columns if c != "order_id"]
    return lines.join(heads.hint("merge"), lines["order_id"] == heads["order_id"]).select(
        lines["order_id"], *keep, *[lines[c] for c in lines.columns if c != "order_id"])


def from_catalog(spark: SparkSession, db: str = "raw") -> Shop:
    """The reference's ``session.table("DB.SCHEMA.T")`` path."""
    return Shop(spark.table(f"{db}.customers"), spark.table(f"{db}.products"),
                spark.table(f"{db}.orders"))
