"""Named queries of the operators beyond the tour: sketches, refreshes,
streams, sessions, as-of and interval joins, percentiles, cubes, heavy hitters,
upserts and literal rows. Same contract as :mod:`cartwheel.queries`."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import TESTDATA_PARAMS as P
from cartwheel.functions.rules import tier_column
from cartwheel.operators.cube import cube_sets, lattice
from cartwheel.operators.heavy import heavy_hitters
from cartwheel.operators.intervals import overlap_join
from cartwheel.operators.ordered import asof_join, sessions
from cartwheel.operators.percentiles import percentiles
from cartwheel.operators.reports import customer_spend, money_as_double
from cartwheel.operators.sketches import error_bound, estimate, levels, sketch_state
from cartwheel.operators.star import customer_totals, meet_heads, month_of, with_customers
from cartwheel.plans import etl
from cartwheel.plans.incremental import CustomerMonths
from cartwheel.plans.parts import PartTable
from cartwheel.plans.sink import remove_path, save_table
from cartwheel.plans.upsert import upsert
from cartwheel.session import ensure_checkpoint_dir, task_count
from cartwheel.sources.catalog import namespace, save_rows
from cartwheel.sources.tables import Shop, from_testdata, read_table
from cartwheel.streaming.events import arriving, upsert_windows, windowed

#: parameters on the test tables
SESSION_GAP = timedelta(hours=6)
EVENT_SHIFT_DAYS = 9131       # 25 years: events fall among the order dates
HEAVY_SHARE = 0.0007          # of all order lines
LG_K = 12
STREAM_SLICES = 3
STREAM_LATENESS = timedelta(hours=24)
WATERMARK = "36 hours"


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def distinct_products_sketch(spark, sf_dir, own):
    """Distinct products by region and month, either and neither, from sketches
    saved per customer and month, beside the exact counts and the bound."""
    shop = from_testdata(spark, sf_dir)
    lines, heads = shop.lines.select("order_id", "product_id"), shop.heads.select("order_id", "customer_id", month_of().alias("month"))
    n_lines = lines.count()  # from the files' footers
    sold = meet_heads(lines, heads, task_count(spark, n_lines))
    table = f"{own.analytics_db}.product_sketches"
    save_table(sketch_state(sold, ["customer_id", "month"], "product_id", LG_K), table)
    state = spark.table(table).join(shop.customers.select("customer_id", "region"), "customer_id")
    sets = cube_sets(["region", "month"])
    told = levels(state, sets, ["region", "month"]).select("level", "region", "month", estimate().alias("estimate"))
    placed = meet_heads(lines, with_customers(heads, shop, "region").drop("customer_id"), task_count(spark, n_lines)).withColumn("n", F.lit(1))
    exact = lattice(placed, ["region", "month"], "product_id", {"n_lines": "n"}, sets, "exact_products", n_lines).select(
        F.element_at(F.array(*[F.lit(x) for x in ("region_month", "region", "month", "all")]), (F.col("grouping_id") + 1).cast("int")).alias("level"),
        F.col("region").alias("r"), F.col("month").alias("m"), "exact_products")
    met = told.join(exact.withColumnRenamed("level", "l"), (F.col("level") == F.col("l")) & F.col("region").eqNullSafe(F.col("r"))
                    & F.col("month").eqNullSafe(F.col("m")))
    bound = error_bound("exact_products", LG_K)
    return met.select("level", "region", "month", "exact_products", bound.alias("error_bound"),
                      (F.abs(F.col("estimate") - F.col("exact_products")) <= bound).alias("within_bound"))


def incremental_monthly_summary(spark, sf_dir, own):
    """The monthly summary from totals that were refreshed twice: lines land in
    two deliveries, and some of their orders only with the second one."""
    shop = from_testdata(spark, sf_dir)
    landing = _scratch(spark, "landing")
    table = f"{own.analytics_db}.customer_months"
    PartTable(spark, table).drop()
    late = F.pmod(F.xxhash64("order_id", "product_id"), F.lit(4)) == 0
    shop.lines.filter(~late).write.parquet(landing)
    CustomerMonths(spark, table, landing).refresh(shop.products, shop.heads.filter("order_id % 97 <> 0"))
    shop.lines.filter(late).write.mode("append").parquet(landing)
    months = CustomerMonths(spark, table, landing)
    months.refresh(shop.products, shop.heads)
    etl.build_monthly_revenue_summary(spark, shop, own, customer_months=months.totals())
    remove_path(spark, landing)
    return money_as_double(spark.table(etl.target(own, etl.MONTHLY_SUMMARY)))


def streamed_event_windows(spark, sf_dir, own):
    """Events by hour and type, streamed: they land in time order in slices, a
    tenth of the last day of each only with the next one; the query stops after
    every slice and goes on from its checkpoint."""
    events = read_table(spark, sf_dir, "events")
    table = f"{own.analytics_db}.event_windows"
    PartTable(spark, table).drop()
    landing, checkpoint = _scratch(spark, "events"), _scratch(spark, "events-checkpoint")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    if span["a"] is not None:
        step = (span["b"] - span["a"]) / STREAM_SLICES
        slice_ = F.lit(0)
        for k in range(1, STREAM_SLICES):
            border = span["a"] + step * k
            held = (F.col("ts") >= F.lit(border - STREAM_LATENESS).cast("timestamp_ntz")) & (F.col("event_id") % 10 == 0)
            slice_ = F.when((F.col("ts") >= F.lit(border).cast("timestamp_ntz")) | held, k).otherwise(slice_)
        for k in range(STREAM_SLICES):
            events.filter(F.col("ts").isNotNull() & (slice_ == k)).write.mode("append").parquet(landing)
            upsert_windows(windowed(arriving(spark, landing), watermark=WATERMARK), table, checkpoint)
    rows = PartTable(spark, table).read()
    return money_as_double(rows if rows is not None else windowed(events))


def event_sessions(spark, sf_dir, own):
    """Sessions of users: runs of events with gaps of at most six hours."""
    value = F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    return money_as_double(sessions(events, "user_id", "ts", SESSION_GAP.total_seconds(),
                                    F.count_if(F.col("event_type") == "purchase").alias("n_purchases"), value))


def events_last_order(spark, sf_dir, own):
    """Every event with its user's latest order day before it."""
    shop = from_testdata(spark, sf_dir)
    days = shop.heads.groupBy(F.col("customer_id").alias("user_id"), F.col("order_date").cast("timestamp_ntz").alias("last_order")).agg(
        F.count(F.lit(1)).alias("orders_that_day"), F.max("order_id").alias("last_order_id"))
    shifted = (F.col("ts") - F.make_dt_interval(F.lit(EVENT_SHIFT_DAYS))).alias("at")
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id", shifted)
    return asof_join(events, days, "user_id", "at", "last_order")


def overlapping_orders(spark, sf_dir, own):
    """Pairs of a customer's orders that were on their way at the same time."""
    shop = from_testdata(spark, sf_dir)
    shipped = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.max("l_shipdate").cast("date").alias("until"))
    open_ = shop.heads.join(shipped, "order_id").select("customer_id", F.col("order_id").alias("order_a"), F.col("order_date").alias("from_a"),
                                                        F.col("until").alias("until_a"))
    other = open_.withColumnsRenamed({"order_a": "order_b", "from_a": "from_b", "until_a": "until_b"})
    days = F.date_diff(F.least("until_a", "until_b"), F.greatest("from_a", "from_b")) + 1
    return overlap_join(open_, other, ("from_a", "until_a"), ("from_b", "until_b"), ["customer_id"], width=64) \
        .filter("order_a < order_b").select("customer_id", "order_a", "order_b", days.alias("overlap_days"))


def spend_percentiles(spark, sf_dir, own):
    """Median, 90th and 99th percentile of the customers' spend, by region."""
    shop = from_testdata(spark, sf_dir)
    spend = with_customers(customer_totals(shop), shop, "region").select("region", F.col("revenue").cast("decimal(18,2)").alias("spend"))
    ranks = {"median_spend": 0.5, "p90_spend": 0.9, "p99_spend": 0.99}
    return money_as_double(percentiles(spend, ["region"], "spend", ranks).withColumnRenamed("n", "customers"))


def revenue_cube(spark, sf_dir, own):
    """Region x category x month and all coarser sets: revenue, lines and
    distinct customers."""
    shop = from_testdata(spark, sf_dir)
    rows = shop.lines.count()  # from the files' footers
    return money_as_double(lattice(cube_base(shop, rows), ["region", "category", "month"], "customer_id", {"revenue": "order_total", "n_lines": "n"},
                                   cube_sets(["region", "category", "month"]), "customers", rows))


def cube_base(shop: Shop, rows: int | None = None) -> DataFrame:
    """The fact once: priced lines, dealt over tasks for so many ``rows`` (all
    lines if not given), with the customer, region and month of their heads."""
    p, l = shop.products, shop.lines
    tasks = task_count(l.sparkSession, l.count() if rows is None else rows)
    priced = l.join(p, "product_id").select("order_id", "category", (F.col("quantity") * F.col("unit_price")).alias("order_total"))
    placed = with_customers(shop.heads.select("order_id", "customer_id", month_of().alias("month")), shop, "region")
    return meet_heads(priced, placed, tasks).withColumn("n", F.lit(1))


def heavy_products(spark, sf_dir, own):
    """Products with more than a share of all order lines."""
    shop = from_testdata(spark, sf_dir)
    found = heavy_hitters(shop.lines, "product_id", HEAVY_SHARE)
    # at most 1 / share rows
    return shop.products.join(F.broadcast(found), "product_id").select("product_id", "product_name", F.col("n").alias("n_lines"),
                                                                       F.col("total").alias("total_lines"))


def upserted_customer_360(spark, sf_dir, own):
    """Customer 360 loaded from the orders of the first years, then brought up
    to date by an upsert of the profiles over all orders, twice."""
    shop = from_testdata(spark, sf_dir)
    table = f"{own.analytics_db}.{etl.CUSTOMER_360}_upserted"
    PartTable(spark, table).drop()
    early = Shop(shop.customers, shop.products, None, shop.lines, shop.heads.filter("order_date < date'1998-01-01'"))
    full = money_as_double(etl.customer_360(shop, own))
    for rows in (money_as_double(etl.customer_360(early, own)), full, full):
        upsert(PartTable(spark, table), rows, ["customer_id"], buckets=16)
    return PartTable(spark, table).read()


def customer_360_dates(spark, sf_dir, own):
    """Customer 360 with the first and last order date."""
    return money_as_double(etl.customer_360(from_testdata(spark, sf_dir), own, with_order_dates=True))


def discounts_from_literal_rows(spark, sf_dir, own):
    """The discount rates as literal rows of a catalog table, found by SQL text
    under its bare name in the current namespace."""
    save_rows(spark, f"{own.raw_db}.discount_rates", "discount_tier string, rate double", P.discount_rates.items())
    shop = from_testdata(spark, sf_dir)
    spend = customer_spend(shop).withColumn("discount_tier", tier_column("total_spend", P.spend_tiers))
    with namespace(spark, own.raw_db):
        return spark.sql("SELECT customer_id, CAST(total_spend AS DOUBLE) AS total_spend, discount_tier, "
                         "CAST(total_spend AS DOUBLE) * rate AS discount_amount FROM {spend} JOIN discount_rates USING (discount_tier)", spend=spend)


BUILDERS = {f.__name__: f for f in (
    distinct_products_sketch, incremental_monthly_summary, streamed_event_windows, event_sessions, events_last_order, overlapping_orders,
    spend_percentiles, revenue_cube, heavy_products, upserted_customer_360, customer_360_dates, discounts_from_literal_rows)}
