"""Named queries over a test-data directory: ``name -> f(spark, sf_dir)``.

Each returns a DataFrame whose money columns are double (cast after exact
decimal arithmetic) and whose column names match :mod:`cartwheel.oracle`.
Queries that save tables do so when called and return the read-back table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from cartwheel import analytics
from cartwheel.config import TESTDATA_PARAMS as P
from cartwheel.config import Params
from cartwheel.functions.rules import register_python_functions, register_sql_functions
from cartwheel.operators import reports as R
from cartwheel.operators.star import order_details as _order_details
from cartwheel.plans import etl
from cartwheel.plans.registry import JobRegistry
from cartwheel.sources.catalog import load_raw_tables as _load_raw_tables
from cartwheel.sources.tables import Shop, from_testdata, read_table

Query = Callable[[SparkSession, str], DataFrame]

MONTHLY_JOB = "build_monthly_revenue_summary_sp"
CUSTOMER_JOB = "build_customer_360_sp"


def _shop(spark: SparkSession, sf_dir: str) -> Shop:
    return from_testdata(spark, sf_dir)


def _d(df: DataFrame) -> DataFrame:
    return R.money_as_double(df)


def _own(query: str, sf_dir: str) -> Params:
    """Parameters with databases of this query and input's own, so that a
    returned frame never reads a table that another query overwrites."""
    path = sf_dir.rstrip("/")
    tag = f"{query}__{re.sub('[^a-z0-9]', '_', path.rsplit('/', 1)[-1].lower())}_{zlib.crc32(path.encode()):08x}"
    return replace(P, raw_db=f"{P.raw_db}__{tag}", analytics_db=f"{P.analytics_db}__{tag}")


def job_registry(sf_dir: str) -> JobRegistry:
    """The two ETL jobs, bound to a test-data directory, by name."""
    reg = JobRegistry()
    reg.register(MONTHLY_JOB, lambda s: etl.build_monthly_revenue_summary(s, _shop(s, sf_dir), P),
                 replace=True)
    reg.register(CUSTOMER_JOB, lambda s: etl.build_customer_360(s, _shop(s, sf_dir), P), replace=True)
    return reg


# ---------------------------------------------------------------- queries
def table_row_counts(spark, sf_dir):
    return R.shop_row_counts(_shop(spark, sf_dir))


def customer_names(spark, sf_dir):
    return R.customer_names(_shop(spark, sf_dir))


def price_with_tax(spark, sf_dir):
    return _d(R.price_with_tax(_shop(spark, sf_dir), P))


def customers_in_region(spark, sf_dir):
    return R.customers_in_region(_shop(spark, sf_dir), P)


def expensive_in_category(spark, sf_dir):
    return _d(R.expensive_in_category(_shop(spark, sf_dir), P))


def price_tier(spark, sf_dir):
    return _d(R.price_tiers(_shop(spark, sf_dir), P))


def order_details(spark, sf_dir):
    return _d(_order_details(_shop(spark, sf_dir)))


def revenue_by_region(spark, sf_dir):
    return _d(R.revenue_by_region(_shop(spark, sf_dir)))


def monthly_revenue(spark, sf_dir):
    return _d(R.monthly_revenue(_shop(spark, sf_dir)))


def top_products(spark, sf_dir):
    return _d(R.top_products(_shop(spark, sf_dir), P))


def category_revenue_by_region(spark, sf_dir):
    return _d(R.category_revenue_by_region(_shop(spark, sf_dir), P))


def customer_spend(spark, sf_dir):
    return _d(R.customer_spend(_shop(spark, sf_dir)))


def customer_tiers(spark, sf_dir):
    return _d(R.customer_tiers(_shop(spark, sf_dir), P))


def customer_tiers_udf(spark, sf_dir):
    return _d(R.customer_tiers_udf(_shop(spark, sf_dir), P))


def customer_tiers_arrow_udf(spark, sf_dir):
    return _d(R.customer_tiers_udf(_shop(spark, sf_dir), P, use_arrow=True))


def tier_summary(spark, sf_dir):
    return _d(R.tier_summary(R.customer_tiers(_shop(spark, sf_dir), P)))


def tier_counts(spark, sf_dir):
    return R.tier_counts(R.customer_tiers(_shop(spark, sf_dir), P))


def email_domain(spark, sf_dir):
    return R.document_email_domains(read_table(spark, sf_dir, "documents"))


def email_domain_udf(spark, sf_dir):
    return R.document_email_domains(read_table(spark, sf_dir, "documents"), python_udf=True)


def customer_discounts(spark, sf_dir):
    return _d(R.customer_discounts(R.customer_tiers(_shop(spark, sf_dir), P), P))


def customer_discounts_udf(spark, sf_dir):
    return _d(R.customer_discounts(R.customer_tiers(_shop(spark, sf_dir), P), P, vectorised=True))


def monthly_revenue_summary(spark, sf_dir):
    own = _own("monthly_revenue_summary", sf_dir)
    etl.build_monthly_revenue_summary(spark, _shop(spark, sf_dir), own)
    return _d(spark.table(etl.target(own, etl.MONTHLY_SUMMARY)))


def monthly_revenue_summary_basic(spark, sf_dir):
    own = _own("monthly_revenue_summary_basic", sf_dir)
    etl.build_monthly_revenue_summary_basic(spark, _shop(spark, sf_dir), own)
    return _d(spark.table(etl.target(own, etl.MONTHLY_SUMMARY_BASIC)))


def customer_360(spark, sf_dir):
    own = _own("customer_360", sf_dir)
    etl.build_customer_360(spark, _shop(spark, sf_dir), own)
    return _d(spark.table(etl.target(own, etl.CUSTOMER_360)))


def monthly_summary_sample(spark, sf_dir):
    own = _own("monthly_summary_sample", sf_dir)
    etl.build_monthly_revenue_summary(spark, _shop(spark, sf_dir), own)
    return _d(etl.monthly_summary_sample(spark, own))


def top_spenders(spark, sf_dir):
    own = _own("top_spenders", sf_dir)
    etl.build_customer_360(spark, _shop(spark, sf_dir), own)
    return _d(etl.top_spenders(spark, own))


def tier_lookup_sql(spark, sf_dir):
    """The tier function called by name from SQL text, over the tables."""
    register_sql_functions(spark, P.spend_tiers)
    return _tier_lookup(spark, sf_dir, "discount_tier(s.total_spend)")


def tier_lookup_python_sql(spark, sf_dir):
    """The Python functions called by name from SQL text, over the tables."""
    register_python_functions(spark, P.spend_tiers, P.discount_rates)
    return _tier_lookup(spark, sf_dir, "discount_tier_py(CAST(s.total_spend AS DOUBLE))",
                        "calculate_discount_amount(CAST(total_spend AS DOUBLE), discount_tier)")


def _tier_lookup(spark, sf_dir, tier, amount=None):
    _shop(spark, sf_dir).register_views()
    rows = f"""
        SELECT c.first_name AS name,
               CAST(s.total_spend AS DOUBLE) AS total_spend,
               {tier} AS discount_tier
        FROM (SELECT h.customer_id, SUM(priced.order_total) AS total_spend
              FROM (SELECT l.order_id, l.quantity * p.unit_price AS order_total
                    FROM shop_lines l JOIN shop_products p ON l.product_id = p.product_id) priced
              JOIN shop_heads h ON priced.order_id = h.order_id
              GROUP BY h.customer_id) s
        JOIN shop_customers c ON s.customer_id = c.customer_id
    """
    return spark.sql(f"SELECT *, {amount} AS discount_amount FROM ({rows})" if amount else rows)


def call_registered_job(spark, sf_dir):
    return job_registry(sf_dir).call(spark, MONTHLY_JOB)


def run_all_jobs(spark, sf_dir):
    status = etl.run_all(spark, _shop(spark, sf_dir), P)
    return spark.createDataFrame([(status,)], "status string")


def load_raw_tables(spark, sf_dir):
    return R.shop_row_counts(_raw(spark, sf_dir, "load_raw_tables"))


def _raw(spark, sf_dir, query) -> Shop:
    own = _own(query, sf_dir)
    return _load_raw_tables(spark, _shop(spark, sf_dir), own.raw_db, own.analytics_db, buckets=own.raw_buckets)


def raw_customers(spark, sf_dir):
    """Content of the loaded raw tables, column by column."""
    return _raw(spark, sf_dir, "raw_customers").customers


def raw_products(spark, sf_dir):
    return _d(_raw(spark, sf_dir, "raw_products").products)


def raw_orders(spark, sf_dir):
    return _raw(spark, sf_dir, "raw_orders").orders


def run_all_monthly_summary(spark, sf_dir):
    """Content of the tables that the orchestrator saves."""
    own = _own("run_all_monthly_summary", sf_dir)
    etl.run_all(spark, _shop(spark, sf_dir), own)
    return _d(spark.table(etl.target(own, etl.MONTHLY_SUMMARY)))


def run_all_customer_360(spark, sf_dir):
    own = _own("run_all_customer_360", sf_dir)
    etl.run_all(spark, _shop(spark, sf_dir), own)
    return _d(spark.table(etl.target(own, etl.CUSTOMER_360)))


def _analytic(name: str) -> Query:
    return lambda spark, sf_dir: analytics.BUILDERS[name](spark, sf_dir, _own(name, sf_dir))


QUERIES: dict[str, Query] = {
    "table_row_counts": table_row_counts,
    "customer_names": customer_names,
    "price_with_tax": price_with_tax,
    "customers_in_region": customers_in_region,
    "expensive_in_category": expensive_in_category,
    "price_tier": price_tier,
    "order_details": order_details,
    "revenue_by_region": revenue_by_region,
    "monthly_revenue": monthly_revenue,
    "top_products": top_products,
    "category_revenue_by_region": category_revenue_by_region,
    "customer_spend": customer_spend,
    "customer_tiers": customer_tiers,
    "customer_tiers_udf": customer_tiers_udf,
    "customer_tiers_arrow_udf": customer_tiers_arrow_udf,
    "tier_summary": tier_summary,
    "tier_counts": tier_counts,
    "email_domain": email_domain,
    "email_domain_udf": email_domain_udf,
    "customer_discounts": customer_discounts,
    "customer_discounts_native": customer_discounts,
    "customer_discounts_udf": customer_discounts_udf,
    "monthly_revenue_summary": monthly_revenue_summary,
    "monthly_revenue_summary_basic": monthly_revenue_summary_basic,
    "customer_360": customer_360,
    "monthly_summary_sample": monthly_summary_sample,
    "top_spenders": top_spenders,
    "tier_lookup_sql": tier_lookup_sql,
    "tier_lookup_python_sql": tier_lookup_python_sql,
    "call_registered_job": call_registered_job,
    "run_all_jobs": run_all_jobs,
    "load_raw_tables": load_raw_tables,
    "raw_customers": raw_customers,
    "raw_products": raw_products,
    "raw_orders": raw_orders,
    "run_all_monthly_summary": run_all_monthly_summary,
    "run_all_customer_360": run_all_customer_360,
    **{name: _analytic(name) for name in analytics.BUILDERS},
}
