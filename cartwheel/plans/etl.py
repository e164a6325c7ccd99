"""The two ETL jobs (monthly revenue summary, customer 360), their saved
outputs, and the orchestrator.

Each job is ``f(spark, shop, params) -> status``: load (lazy frames) ->
join/aggregate -> classify -> overwrite-save -> count the saved table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.config import ALL_JOBS_STATUS, Params
from cartwheel.functions.rules import tier_column
from cartwheel.operators.star import (
    avg_of,
    customer_month_totals,
    customer_totals,
    priced_lines,
    with_customers,
)
from cartwheel.plans.sink import materialize, remove_path, save_table, saved_row_count_status
from cartwheel.sources.tables import Shop

DEFAULT = Params()

MONTHLY_SUMMARY = "monthly_revenue_summary"
MONTHLY_SUMMARY_BASIC = "monthly_revenue_summary_basic"
CUSTOMER_360 = "customer_360"


def target(params: Params, name: str) -> str:
    return f"{params.analytics_db}.{name}"


# ------------------------------------------------------------------ frames
def monthly_revenue_summary(shop: Shop, params: Params = DEFAULT, with_unique_customers: bool = True,
                            customer_months: DataFrame | None = None,
                            approx_distinct_rsd: float | None = None) -> DataFrame:
    """Region x month: revenue, order count, mean order value, distinct
    customers (by id), revenue tier. Lines are first summed per
    (customer, month), so the customer join sees one row per customer-month,
    not one per line. The distinct count is exact; ``approx_distinct_rsd``
    opts into HyperLogLog++ (``approx_count_distinct``) with that relative
    standard deviation."""
    cm = customer_months if customer_months is not None else customer_month_totals(shop)
    per_cm = with_customers(cm, shop, "region")
    measures = [F.sum("revenue").alias("total_revenue"),
                F.sum("n_orders").alias("order_count"),
                F.sum("n_totals").alias("_n")]
    if with_unique_customers:
        distinct = (F.count_distinct("customer_id") if approx_distinct_rsd is None
                    else F.approx_count_distinct("customer_id", rsd=approx_distinct_rsd))
        measures.append(distinct.alias("unique_customers"))
    summary = per_cm.groupBy("region", "month").agg(*measures)
    cols = ["region", "month", "total_revenue", "order_count",
            avg_of("total_revenue", "_n").alias("avg_order_value")]
    if with_unique_customers:
        cols.append("unique_customers")
    return (summary.select(*cols)
                   .withColumn("revenue_tier", tier_column("total_revenue", params.revenue_tiers)))


def customer_360(shop: Shop, params: Params = DEFAULT, customer_months: DataFrame | None = None,
                 with_order_dates: bool = False) -> DataFrame:
    """One profile row per customer with orders: spend, order count, mean
    order value, discount tier. Customers without orders drop out (inner).
    ``with_order_dates`` adds first/last order date (promised by the
    original docstring, not computed by its code)."""
    if with_order_dates:
        metrics = _metrics_with_dates(shop)
    else:
        metrics = customer_totals(shop, customer_months=customer_months)
    c = shop.customers
    profile = [c["customer_id"], c["first_name"], c["last_name"]]
    profile += [c[name] for name in ("email",) if name in c.columns]
    profile.append(c["region"])
    profile += [c[name] for name in ("signup_date",) if name in c.columns]
    extra = [metrics[n] for n in ("first_order_date", "last_order_date") if n in metrics.columns]
    return (c.join(metrics, c["customer_id"] == metrics["customer_id"])
             .select(*profile,
                     metrics["revenue"].alias("total_spend"),
                     metrics["n_orders"].alias("order_count"),
                     avg_of("revenue", "n_totals").alias("avg_order_value"),
                     tier_column(metrics["revenue"], params.spend_tiers).alias("discount_tier"),
                     *extra))


def _metrics_with_dates(shop: Shop) -> DataFrame:
    return priced_lines(shop).groupBy("customer_id").agg(
        F.sum("order_total").alias("revenue"), F.count("order_id").alias("n_orders"),
        F.count("order_total").alias("n_totals"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))


# -------------------------------------------------------------------- jobs
def build_monthly_revenue_summary(spark: SparkSession, shop: Shop, params: Params = DEFAULT,
                                  customer_months: DataFrame | None = None) -> str:
    t = target(params, MONTHLY_SUMMARY)
    save_table(monthly_revenue_summary(shop, params, customer_months=customer_months), t)
    return saved_row_count_status(spark, t)


def build_monthly_revenue_summary_basic(spark: SparkSession, shop: Shop, params: Params = DEFAULT) -> str:
    t = target(params, MONTHLY_SUMMARY_BASIC)
    save_table(monthly_revenue_summary(shop, params, with_unique_customers=False), t)
    return saved_row_count_status(spark, t)


def build_customer_360(spark: SparkSession, shop: Shop, params: Params = DEFAULT,
                       customer_months: DataFrame | None = None) -> str:
    t = target(params, CUSTOMER_360)
    save_table(customer_360(shop, params, customer_months=customer_months), t)
    return saved_row_count_status(spark, t)


def monthly_summary_sample(spark: SparkSession, params: Params = DEFAULT) -> DataFrame:
    """First rows of the saved summary by month (region breaks ties)."""
    return (spark.table(target(params, MONTHLY_SUMMARY))
            .orderBy("month", "region").limit(params.sample_rows))


def top_spenders(spark: SparkSession, params: Params = DEFAULT) -> DataFrame:
    """Top spenders of the saved customer 360 (customer_id breaks ties)."""
    return (spark.table(target(params, CUSTOMER_360))
            .orderBy(F.col("total_spend").desc(), F.col("customer_id")).limit(params.sample_rows))


def run_all(spark: SparkSession, shop: Shop, params: Params = DEFAULT, show: bool = False) -> str:
    """Run both jobs, fail-fast, and return the joined status.

    Both outputs derive from the per-(customer, month) totals. Those are
    computed once and written as parquet under ``spark.checkpoint.dir``
    (shared, reliable storage), so the second job neither recomputes the
    fact joins nor depends on executors of the first one. The intermediate
    is removed when both jobs are done."""
    customer_months, path = materialize(customer_month_totals(shop), "customer_months")
    try:
        r1 = build_monthly_revenue_summary(spark, shop, params, customer_months=customer_months)
        r2 = build_customer_360(spark, shop, params, customer_months=customer_months)
    finally:
        remove_path(spark, path)
    if show:
        monthly_summary_sample(spark, params).show()
        top_spenders(spark, params).show()
    return ALL_JOBS_STATUS.format(first=r1, second=r2)
