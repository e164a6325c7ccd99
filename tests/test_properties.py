"""Property test: on random small shops (duplicate keys, NULL keys and
measures, orphans, shared names) every pre-aggregated report equals the
plain row-level star join followed by one GROUP BY."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwheel.config import Params
from cartwheel.operators import reports as R
from cartwheel.operators.star import month_of, order_details
from cartwheel.plans import etl
from cartwheel.sources.catalog import frames_from_rows

P = Params(category="A", min_category_revenue=50.0, top_products=3)

ids = st.one_of(st.none(), st.integers(1, 6))
customers = st.lists(st.tuples(ids, st.sampled_from(["Ann", "Bo", "Cy", None]), st.just("X"), st.none(),
                               st.sampled_from(["North", "South", None]), st.none()), max_size=8)
prices = st.one_of(st.none(), st.decimals(min_value=0, max_value=300, places=2, allow_nan=False))
products = st.lists(st.tuples(ids, st.sampled_from(["p", "q", "r"]), st.sampled_from(["A", "B"]), prices),
                    max_size=6)
dates = st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 4, 30)))
orders = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 30)), ids, ids,
                            st.one_of(st.none(), st.integers(0, 5)), dates), max_size=25)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def avg(c):
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(customers, products, orders)
def test_reports_equal_row_level_join(spark, cs, ps, os_):
    shop = frames_from_rows(spark, cs, [(a, b, c, Decimal(d) if d is not None else None) for a, b, c, d in ps], os_)
    od = order_details(shop, with_customer_id=True)

    naive = od.groupBy("region").agg(F.sum("order_total").alias("total_revenue"),
                                     F.count("order_id").alias("order_count"),
                                     avg("order_total").alias("avg_order_value"))
    assert bag(R.revenue_by_region(shop)) == bag(naive)

    naive = od.groupBy(month_of().alias("month")).agg(
        F.sum("order_total").alias("revenue"), F.count_distinct("first_name").alias("unique_customers"))
    assert bag(R.monthly_revenue(shop)) == bag(naive)

    naive = od.groupBy("product_name").agg(F.sum("order_total").alias("total_revenue"))
    assert bag(R.top_products(shop, Params(top_products=100))) == bag(naive)

    naive = (od.filter(F.col("category") == "A").groupBy(F.upper("region").alias("region"))
               .agg(F.sum("order_total").alias("revenue"), F.count("order_id").alias("num_orders"))
               .filter(F.col("revenue") > 50.0))
    assert bag(R.category_revenue_by_region(shop, P)) == bag(naive)

    naive = (od.groupBy("region", month_of().alias("month"))
               .agg(F.sum("order_total").alias("total_revenue"), F.count("order_id").alias("order_count"),
                    avg("order_total").alias("avg_order_value"),
                    F.count_distinct("cust_id").alias("unique_customers")))
    assert bag(etl.monthly_revenue_summary(shop, P).drop("revenue_tier")) == bag(naive)
