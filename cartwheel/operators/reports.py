"""The tour's reports as ``Shop -> DataFrame`` functions.

Money stays ``decimal`` here (exact); :func:`money_as_double` converts a
finished result for consumers that want floating point.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.config import Params
from cartwheel.functions.email import domain_column, domain_udf, emails_in
from cartwheel.functions.rules import (
    discount_amount_column,
    discount_amount_pandas_udf,
    tier_column,
    tier_udf,
)
from cartwheel.operators.star import (
    avg_of,
    customer_month_totals,
    customer_totals,
    month_of,
    priced_lines,
    product_quantities,
    with_customers,
)
from cartwheel.sources.tables import Shop

DEFAULT = Params()


def money_as_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double (after exact decimal arithmetic)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


# ------------------------------------------------------------ scans, counts
def table_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of one-row ``count(*)`` aggregates, one per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def shop_row_counts(shop: Shop) -> DataFrame:
    return table_row_counts({"CUSTOMERS": shop.customers, "PRODUCTS": shop.products,
                             "ORDERS": shop.orders})


# --------------------------------------------------- projections and filters
def customer_names(shop: Shop) -> DataFrame:
    return shop.customers.select(F.col("first_name"), F.col("last_name"), F.col("region"))


def price_with_tax(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    return (shop.products
            .withColumn("price_with_tax", F.col("unit_price") * F.lit(params.tax_factor))
            .select("product_name", "unit_price", "price_with_tax"))


def customers_in_region(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    return shop.customers.filter(F.col("region") == params.region)


def expensive_in_category(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    return (shop.products
            .filter((F.col("category") == params.category) & (F.col("unit_price") > params.min_price))
            .select("product_name", "unit_price"))


def price_tiers(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    return shop.products.select(
        F.col("product_name"), F.col("unit_price"),
        tier_column("unit_price", params.price_tiers).alias("price_tier"))


# -------------------------------------------------------------- aggregates
def revenue_by_region(shop: Shop) -> DataFrame:
    """Revenue, order count and mean order value per region, largest first.
    Lines are summed per customer before the customer join."""
    per_customer = with_customers(customer_totals(shop), shop, "region")
    return (per_customer.groupBy("region")
            .agg(F.sum("revenue").alias("total_revenue"),
                 F.sum("n_orders").alias("order_count"),
                 F.sum("n_totals").alias("_n"))
            .select("region", "total_revenue", "order_count",
                    avg_of("total_revenue", "_n").alias("avg_order_value"))
            .orderBy(F.col("total_revenue").desc()))


def monthly_revenue(shop: Shop) -> DataFrame:
    """Revenue per month and distinct customers *by first name*."""
    per_cm = with_customers(customer_month_totals(shop), shop, "first_name")
    return (per_cm.groupBy("month")
            .agg(F.sum("revenue").alias("revenue"),
                 F.count_distinct("first_name").alias("unique_customers"))
            .orderBy("month"))


def top_products(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    """Top-k product names by revenue (ties by name). Products sharing a
    name are merged, as grouping by name implies. Quantities are summed per
    product before the price join: sum(q * price) = price * sum(q) exactly."""
    q = product_quantities(shop)
    p = shop.products
    return (q.join(p, q["product_id"] == p["product_id"])
             .groupBy(p["product_name"])
             .agg(F.sum(q["quantity"] * p["unit_price"]).alias("total_revenue"))
             .orderBy(F.col("total_revenue").desc(), F.col("product_name"))
             .limit(params.top_products))


def category_revenue_by_region(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    """One category's revenue per upper-cased region, kept above a floor."""
    per_customer = with_customers(customer_totals(shop, category=params.category), shop, "region")
    return (per_customer.groupBy(F.upper(F.col("region")).alias("region"))
            .agg(F.sum("revenue").alias("revenue"), F.sum("n_orders").alias("num_orders"))
            .filter(F.col("revenue") > params.min_category_revenue)
            .orderBy(F.col("revenue").desc()))


# ------------------------------------------------------ customer spend, tiers
def customer_spend(shop: Shop) -> DataFrame:
    """Lifetime spend per orders.customer_id (no customer join, so orders
    of unknown customers keep their own row)."""
    return customer_totals(shop).select("customer_id", F.col("revenue").alias("total_spend"))


def _spend_with_customer(shop: Shop) -> DataFrame:
    spend = customer_spend(shop)
    c = shop.customers
    return spend.join(c, spend["customer_id"] == c["customer_id"]).select(
        c["customer_id"], c["first_name"], c["last_name"], c["region"], spend["total_spend"])


def _biggest_spend_first(df: DataFrame) -> DataFrame:
    """Spend descending. customer_id breaks ties: a global sort range-partitions
    on its keys and cannot split one hot value (say a third of all customers
    with the same spend) across tasks; the tie-breaker lets it. Dropped after."""
    return df.orderBy(F.col("total_spend").desc(), F.col("customer_id")).drop("customer_id")


def customer_tiers(shop: Shop, params: Params = DEFAULT) -> DataFrame:
    """Spend joined to the customer, with the native tier CASE, biggest first."""
    return _biggest_spend_first(
        _spend_with_customer(shop)
        .withColumn("discount_tier", tier_column("total_spend", params.spend_tiers)))


def customer_tiers_udf(shop: Shop, params: Params = DEFAULT, use_arrow: bool = False) -> DataFrame:
    """Same as :func:`customer_tiers` through the Python UDF twin. The UDF
    stands above the sort: a range-partitioned sort runs its input twice (once
    to sample it)."""
    tier = tier_udf(params.spend_tiers, use_arrow=use_arrow)
    return (_biggest_spend_first(_spend_with_customer(shop))
            .withColumn("discount_tier", tier(F.col("total_spend").cast("double"))))


def tier_summary(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("discount_tier").agg(F.sum("total_spend").alias("tier_total_spend"))


def tier_counts(tiers: DataFrame) -> DataFrame:
    return tiers.groupBy("discount_tier").count()


def customer_discounts(tiers: DataFrame, params: Params = DEFAULT, vectorised: bool = False) -> DataFrame:
    """Discount amount = spend * rate(tier), biggest first. Native by default;
    ``vectorised`` computes the column with the pandas UDF (Arrow batches),
    above a sort on the native amount, so that the UDF runs once per row."""
    spend = F.col("total_spend").cast("double")
    native = discount_amount_column(spend, "discount_tier", params.discount_rates)
    # every Bronze customer has amount 0.0: spend and name break the ties so
    # the range-partitioned sort can spread that hot value over many tasks
    ranked = tiers.withColumn("discount_amount", native).orderBy(
        F.col("discount_amount").desc(), F.col("total_spend").desc(), F.col("first_name"))
    if vectorised:
        amount = discount_amount_pandas_udf(params.discount_rates)(spend, F.col("discount_tier"))
        ranked = ranked.withColumn("discount_amount", amount)
    return ranked.select("first_name", "total_spend", "discount_tier", "discount_amount")


# ------------------------------------------------------------------ e-mail
def customer_domains(customers: DataFrame, python_udf: bool = False) -> DataFrame:
    """first_name, email, domain for frames that carry an ``email`` column."""
    domain = domain_udf()(F.col("email")) if python_udf else domain_column("email")
    return customers.select("first_name", "email", domain.alias("domain"))


def document_email_domains(documents: DataFrame, python_udf: bool = False) -> DataFrame:
    """Every e-mail address found in the whole text of each document, with
    its domain. Map-only: no shuffle. Every match contains ``@``, so texts
    without one skip the regex (a byte scan instead of a backtracking match)."""
    found = (documents.filter(F.col("text").contains("@"))
                      .select("doc_id", F.explode(emails_in("text")).alias("email")))
    domain = domain_udf()(F.col("email")) if python_udf else domain_column("email")
    return found.select("doc_id", "email", domain.alias("domain"))


__all__ = [
    "category_revenue_by_region", "customer_discounts", "customer_domains", "customer_names",
    "customer_spend", "customer_tiers", "customer_tiers_udf", "customers_in_region",
    "document_email_domains", "expensive_in_category", "money_as_double", "monthly_revenue",
    "price_tiers", "price_with_tax", "revenue_by_region", "shop_row_counts", "table_row_counts",
    "tier_counts", "tier_summary", "top_products",
    # re-exported building blocks
    "customer_month_totals", "customer_totals", "month_of", "priced_lines",
]
