"""The pre-aggregated plans equal the plain row-level star join followed by
one GROUP BY, also with duplicate dimension keys, NULL keys and NULL
measures (the messy fixture)."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwheel.config import Params
from cartwheel.operators import reports as R
from cartwheel.operators.star import month_of, order_details
from cartwheel.plans import etl

P = Params(category="Electronics", min_category_revenue=100.0)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def avg(total, n):
    return F.try_divide(F.sum(total).cast("double"), F.count(total).cast("double"))


@pytest.fixture(params=["shop", "messy_shop"])
def any_shop(request):
    return request.getfixturevalue(request.param)


def test_revenue_by_region(any_shop):
    od = order_details(any_shop)
    naive = od.groupBy("region").agg(F.sum("order_total").alias("total_revenue"),
                                     F.count("order_id").alias("order_count"),
                                     avg("order_total", "order_total").alias("avg_order_value"))
    assert bag(R.revenue_by_region(any_shop)) == bag(naive)


def test_monthly_revenue(any_shop):
    od = order_details(any_shop)
    naive = od.groupBy(month_of().alias("month")).agg(
        F.sum("order_total").alias("revenue"), F.count_distinct("first_name").alias("unique_customers"))
    assert bag(R.monthly_revenue(any_shop)) == bag(naive)


def test_top_products(any_shop):
    od = order_details(any_shop)
    naive = (od.groupBy("product_name").agg(F.sum("order_total").alias("total_revenue"))
               .orderBy(F.col("total_revenue").desc(), "product_name").limit(P.top_products))
    assert [tuple(r) for r in R.top_products(any_shop, P).collect()] == [tuple(r) for r in naive.collect()]


def test_category_revenue(any_shop):
    od = order_details(any_shop)
    naive = (od.filter(F.col("category") == P.category)
               .groupBy(F.upper("region").alias("region"))
               .agg(F.sum("order_total").alias("revenue"), F.count("order_id").alias("num_orders"))
               .filter(F.col("revenue") > P.min_category_revenue))
    assert bag(R.category_revenue_by_region(any_shop, P)) == bag(naive)


def test_monthly_summary(any_shop):
    od = order_details(any_shop, with_customer_id=True)
    naive = (od.groupBy("region", month_of().alias("month"))
               .agg(F.sum("order_total").alias("total_revenue"), F.count("order_id").alias("order_count"),
                    avg("order_total", "order_total").alias("avg_order_value"),
                    F.count_distinct("cust_id").alias("unique_customers")))
    got = etl.monthly_revenue_summary(any_shop, P).drop("revenue_tier")
    assert bag(got) == bag(naive)


def test_customer_360(any_shop):
    o, p, c = any_shop.orders, any_shop.products, any_shop.customers
    metrics = (o.join(p, o["product_id"] == p["product_id"])
                .groupBy(o["customer_id"])
                .agg(F.sum(o["quantity"] * p["unit_price"]).alias("total_spend"),
                     F.count(o["order_id"]).alias("order_count"),
                     avg(o["quantity"] * p["unit_price"], None).alias("avg_order_value")))
    naive = c.join(metrics, c["customer_id"] == metrics["customer_id"]).select(
        c["customer_id"], metrics["total_spend"], metrics["order_count"], metrics["avg_order_value"])
    got = etl.customer_360(any_shop, P).select("customer_id", "total_spend", "order_count", "avg_order_value")
    assert bag(got) == bag(naive)
    months = R.customer_month_totals(any_shop)
    shared = etl.customer_360(any_shop, P, customer_months=months).select(*got.columns)
    assert bag(shared) == bag(got)
