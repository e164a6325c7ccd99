"""Golden values on the invented sample shop (computed by hand)."""

from __future__ import annotations

from conftest import D, day
from pyspark.sql import functions as F

from cartwheel.config import Params
from cartwheel.operators import reports as R
from cartwheel.operators.star import order_details

P = Params()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_row_counts(shop):
    assert sorted(rows(R.shop_row_counts(shop))) == [("CUSTOMERS", 6), ("ORDERS", 11), ("PRODUCTS", 5)]


def test_projection_filter_and_price_tiers(shop):
    assert R.customer_names(shop).columns == ["first_name", "last_name", "region"]
    assert R.customers_in_region(shop, P).count() == 2
    assert sorted(rows(R.expensive_in_category(shop, P))) == [("Monitor", D("199.00"))]
    tiers = dict((n, t) for n, _, t in rows(R.price_tiers(shop, P).filter(F.col("product_name") != "Mouse")))
    assert tiers == {"Lamp": "Budget", "Desk": "Premium", "Monitor": "Standard"}


def test_price_with_tax_is_double(shop):
    got = {n: v for n, _, v in rows(R.price_with_tax(shop, P))}
    assert abs(got["Desk"] - 270.0) < 1e-9
    assert abs(got["Lamp"] - 49.14) < 1e-9
    assert dict(R.price_with_tax(shop, P).dtypes)["price_with_tax"] == "double"


def test_order_details_inner_joins(shop):
    od = order_details(shop)
    assert od.count() == 9                       # orphan customer and orphan product dropped
    assert od.agg(F.sum("order_total")).first()[0] == D("1494.42")


def test_revenue_by_region(shop):
    got = rows(R.revenue_by_region(shop))
    assert [r[0] for r in got] == ["North", "South", "East"]          # descending revenue
    assert got[0][1:3] == (D("943.50"), 4) and abs(got[0][3] - 235.875) < 1e-12
    assert got[1][1:3] == (D("450.97"), 4) and abs(got[1][3] - 112.7425) < 1e-12
    assert got[2][1:3] == (D("99.95"), 1)


def test_monthly_revenue_counts_distinct_first_names(shop):
    got = rows(R.monthly_revenue(shop))
    assert got == [
        (day("2024-01-01"), D("758.97"), 2),
        (day("2024-02-01"), D("95.50"), 2),
        (day("2024-03-01"), D("548.95"), 3),
        (day("2024-04-01"), D("91.00"), 1),
    ]


def test_top_products_merges_names_and_orders(shop):
    got = rows(R.top_products(shop, P))
    assert got == [("Desk", D("750.00")), ("Monitor", D("398.00")), ("Mouse", D("209.92")),
                   ("Lamp", D("136.50"))]
    two = Params(top_products=2)
    assert [r[0] for r in rows(R.top_products(shop, two))] == ["Desk", "Monitor"]


def test_category_revenue_having(shop):
    assert rows(R.category_revenue_by_region(shop, P)) == []            # published floor: 1000
    got = rows(R.category_revenue_by_region(shop, Params(min_category_revenue=100.0)))
    assert got == [("NORTH", D("398.00"), 2), ("SOUTH", D("109.97"), 2)]


def test_customer_spend_keeps_unknown_customers(shop):
    got = dict(rows(R.customer_spend(shop)))
    assert got == {1: D("699.00"), 2: D("109.97"), 3: D("244.50"), 4: D("99.95"),
                   6: D("341.00"), 99: D("199.00")}


def test_customer_tiers_and_summaries(shop):
    tiers = R.customer_tiers(shop, P)
    got = rows(tiers)
    assert [(r[0], r[3], r[4]) for r in got] == [
        ("Ana", D("699.00"), "Platinum"), ("Ana", D("341.00"), "Gold"), ("Cy", D("244.50"), "Gold"),
        ("Ben", D("109.97"), "Silver"), ("Dee", D("99.95"), "Bronze")]
    assert dict(rows(R.tier_counts(tiers))) == {"Platinum": 1, "Gold": 2, "Silver": 1, "Bronze": 1}
    assert dict(rows(R.tier_summary(tiers))) == {
        "Platinum": D("699.00"), "Gold": D("585.50"), "Silver": D("109.97"), "Bronze": D("99.95")}


def test_discounts_pandas_and_native_agree(shop):
    tiers = R.customer_tiers(shop, P)
    vec = rows(R.customer_discounts(tiers, P, vectorised=True))
    nat = rows(R.customer_discounts(tiers, P, vectorised=False))
    assert vec == nat
    assert [round(r[3], 6) for r in vec] == [104.85, 34.1, 24.45, 5.4985, 0.0]
    assert abs(sum(r[3] for r in vec) - 168.8985) < 1e-9


def test_customer_domains(shop):
    got = dict((e, d) for _, e, d in rows(R.customer_domains(shop.customers)))
    assert got == {"ana@shop.io": "shop.io", "ben@mail.net": "mail.net",
                   "cy.park@corp.co.uk": "corp.co.uk", "dee@": "", None: "unknown", "a@b@c": "b"}
    assert rows(R.customer_domains(shop.customers, python_udf=True)) == rows(R.customer_domains(shop.customers))


def test_invariants(shop):
    total = order_details(shop).agg(F.sum("order_total")).first()[0]
    assert R.revenue_by_region(shop).agg(F.sum("total_revenue")).first()[0] == total
    assert R.monthly_revenue(shop).agg(F.sum("revenue")).first()[0] == total
    tiers = R.customer_tiers(shop, P)
    assert R.tier_summary(tiers).agg(F.sum("tier_total_spend")).first()[0] == total
    assert R.tier_counts(tiers).agg(F.sum("count")).first()[0] == tiers.count()


def test_count_semantics(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    got = df.agg(F.count("v"), F.count(F.lit(1)), F.count_distinct("v")).first()
    assert tuple(got) == (1, 2, 1)


def test_desc_sort_puts_null_revenue_last(messy_shop):
    got = rows(R.revenue_by_region(messy_shop))
    assert got[-1][0] is None and got[-1][1] is None          # region NULL: all its totals are NULL
    assert [r[1] for r in got[:-1]] == sorted((r[1] for r in got[:-1]), reverse=True)
