"""One customer holding a third of all order lines: join keys are split by
AQE skew handling, aggregates combine map-side, results stay exact."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import reports as R
from cartwheel.operators.star import order_details
from cartwheel.sources.catalog import frames_from_rows

LINES = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    s = spark.newSession()  # own SQL conf: thresholds scaled down to test size
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }.items():
        s.conf.set(key, value)
    customers = [(i, f"c{i}", "x", None, ["North", "South"][i % 2], None) for i in range(1, 201)]
    products = [(p, f"p{p}", "A", Decimal("1.50")) for p in range(1, 51)]
    orders = [(i, 1 if i % 3 == 0 else (i % 200) + 1, (i % 50) + 1, 1, dt.date(2024, 1 + i % 12, 1))
              for i in range(LINES)]
    return frames_from_rows(s, customers, products, orders)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_customer_join_is_split(skewed):
    df = order_details(skewed)
    assert df.count() == LINES
    df.collect()
    text = plan(df)
    assert "SortMergeJoin(skew=true)" in text and "AQEShuffleRead skewed" in text


def test_hot_customer_aggregates_exact(skewed):
    got = {r.region: (r.total_revenue, r.order_count) for r in R.revenue_by_region(skewed).collect()}
    od = order_details(skewed)
    want = {r[0]: (r[1], r[2]) for r in od.groupBy("region").agg(F.sum("order_total"), F.count("order_id")).collect()}
    assert got == want
    assert sum(c for _, c in got.values()) == LINES
    hot_lines = sum(1 for i in range(LINES) if i % 3 == 0 or i % 200 == 0)     # customer 1
    assert hot_lines > LINES // 3
    hot = R.customer_spend(skewed).filter("customer_id = 1").first().total_spend
    assert hot == Decimal("1.50") * hot_lines


def test_hot_sort_values_have_tie_breakers(shop):
    from cartwheel.config import Params
    tiers = R.customer_tiers(shop, Params())
    text = plan(tiers)
    sort_line = [line for line in text.splitlines() if "Sort [total_spend" in line][0]
    assert "customer_id" in sort_line
    assert tiers.columns == ["first_name", "last_name", "region", "total_spend", "discount_tier"]
    text = plan(R.customer_discounts(tiers, Params(), vectorised=False))
    sort_line = [line for line in text.splitlines() if "Sort [discount_amount" in line][0]
    assert "total_spend" in sort_line
