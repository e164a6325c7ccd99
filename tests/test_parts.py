"""Part tables, upserts and the incremental refresh."""

from __future__ import annotations

import datetime as dt
import os
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.star import customer_month_totals
from cartwheel.plans import etl
from cartwheel.plans.incremental import CustomerMonths
from cartwheel.plans.parts import ConcurrentCommit, PartTable
from cartwheel.plans.upsert import upsert
from cartwheel.session import output_root
from cartwheel.sources.tables import Shop


@pytest.fixture
def name():
    return f"parts_tests.t{uuid.uuid4().hex[:10]}"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ----------------------------------------------------------------- part tables
def test_commit_replaces_only_named_parts(spark, name):
    t = PartTable(spark, name)
    assert t.read() is None and t.parts() == {}
    frame = lambda rows: spark.createDataFrame(rows, "p string, x int")
    t.commit(frame([("a", 1), ("a", 2), ("b/ö", 3)]), "p", {"a", "b/ö"})
    first = t.parts()
    assert rows_of(t.read()) == [(1,), (2,), (3,)]
    t.commit(frame([("a", 9)]), "p", {"a"})
    assert t.parts()["b/ö"] == first["b/ö"] and rows_of(t.read()) == [(3,), (9,)]
    assert os.path.isdir(first["a"].removeprefix("file:"))  # for readers still on it
    t.commit(frame([]), "p", {"a"})  # a part without rows goes
    assert rows_of(PartTable(spark, name).read()) == [(3,)]
    assert not os.path.isdir(first["a"].removeprefix("file:"))
    assert rows_of(t.read({"none"})) == []


def test_commit_refuses_strangers_and_other_writers(spark, name):
    frame = lambda rows: spark.createDataFrame(rows, "p string, x int")
    t, other = PartTable(spark, name), PartTable(spark, name)
    with pytest.raises(ValueError):
        t.commit(frame([("a", 1), ("b", 1)]), "p", {"a"})
    t.commit(frame([("a", 1)]), "p", {"a"})
    with pytest.raises(ConcurrentCommit):
        other.commit(frame([("a", 2)]), "p", {"a"})
    with pytest.raises(ValueError):
        t.commit(spark.createDataFrame([("a", "x")], "p string, x string"), "p", {"a"})
    assert rows_of(PartTable(spark, name).read()) == [(1,)]


# --------------------------------------------------------------------- upserts
def test_upserts_against_a_dictionary(spark, name):
    rnd = random.Random(2)
    want: dict = {}
    for _ in range(4):
        batch = {(rnd.choice([None, *range(30)]), rnd.choice("ab")): rnd.choice([None, 1.5, float("nan"), 7.0]) for _ in range(25)}
        want.update(batch)
        df = spark.createDataFrame([(*k, v) for k, v in batch.items()], "k long, g string, v double")
        t = PartTable(spark, name)
        before = t.parts()
        done = upsert(t, df, ["k", "g"], buckets=8)
        after = t.parts()
        assert repr(rows_of(t.read())) == repr(sorted(((*k, v) for k, v in want.items()), key=repr))  # NaN equals NaN
        assert {b for b in before if after.get(b) == before[b]} == set(before) - set(done.rewritten)
        live = t.began
        again = upsert(PartTable(spark, name), df, ["k", "g"], buckets=8)  # a rerun writes nothing
        assert again.changed == 0 and again.rewritten == () and PartTable(spark, name).began == live


def test_upsert_rewrites_the_changed_buckets_only(spark, name):
    base = spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    t = PartTable(spark, name)
    assert upsert(t, base, ["k"], 16).changed == 400
    done = upsert(t, base.withColumn("v", F.when(F.col("k") == 7, "y").otherwise("x")), ["k"], 16)
    assert done.changed == 1 and len(done.rewritten) == 1 and done.kept == len(t.parts()) - 1


def test_upsert_odd_input(spark, name):
    schema = "k long, v string"
    t = PartTable(spark, name)
    assert upsert(t, spark.createDataFrame([], schema), ["k"]).changed == 0
    assert rows_of(t.read()) == []
    with pytest.raises(ValueError):
        upsert(t, spark.createDataFrame([(1, "a"), (1, "b")], schema), ["k"])
    upsert(t, spark.createDataFrame([(1, "a"), (None, "n")], schema), ["k"])
    upsert(t, t.read().withColumn("v", F.upper("v")), ["k"])  # rows made from the table itself
    assert rows_of(t.read()) == [(1, "A"), (None, "N")]
    with pytest.raises(ValueError):
        upsert(t, spark.createDataFrame([(1,)], "k long"), ["k"])


# --------------------------------------------------------- incremental refresh
LINE = "order_id long, product_id long, quantity int"


@pytest.fixture
def shop_parts(spark):
    rnd = random.Random(8)
    products = spark.createDataFrame([(p, f"p{p}", "c", Decimal(p) + Decimal("0.25")) for p in range(12)] + [(3, "twin", "c", Decimal("1.00"))],
                                     "product_id long, product_name string, category string, unit_price decimal(10,2)")
    heads = [(o, o % 9 if o % 11 else None, dt.date(2024, 1 + o % 5, 1 + o % 28) if o % 13 else None) for o in range(100)]
    lines = [(rnd.choice([None, *range(110)]), rnd.choice([None, *range(13)]), rnd.choice([None, 1, 2, 5])) for _ in range(500)]
    return products, heads, lines


def rebuilt(spark, products, heads, lines):
    shop = Shop(None, products, None, spark.createDataFrame(lines, LINE),
                spark.createDataFrame(heads, "order_id long, customer_id long, order_date date"))
    return rows_of(customer_month_totals(shop).selectExpr("customer_id", "month", "cast(revenue as decimal(38,2)) revenue", "n_orders", "n_totals"))


def land(spark, folder, lines):
    spark.createDataFrame(lines, LINE).coalesce(1).write.mode("append").parquet(folder)


def test_refresh_equals_full_rebuild(spark, name, shop_parts, tmp_path):
    products, heads, lines = shop_parts
    head_frame = lambda rows: spark.createDataFrame(rows, "order_id long, customer_id long, order_date date")
    folder = f"{tmp_path}/landing"
    months = CustomerMonths(spark, name, folder)
    land(spark, folder, lines[:200])
    land(spark, folder, lines[200:300])
    early = [h for h in heads if h[0] % 6]  # every sixth head comes later
    few = products.filter("product_id <> 5")
    first = months.refresh(few, head_frame(early))
    assert first.files == 2 and first.waiting > 0 and not first.rebuilt
    land(spark, folder, lines[300:])
    second = CustomerMonths(spark, name, folder).refresh(products, head_frame(heads))
    assert second.files == 1
    assert rows_of(CustomerMonths(spark, name, folder).totals()) == rebuilt(spark, products, heads, lines)
    # lines whose order never comes still wait; nothing else is read again
    last = CustomerMonths(spark, name, folder).refresh(products, head_frame(heads))
    assert (last.files, last.months, last.waiting) == (0, (), second.waiting)
    assert rows_of(CustomerMonths(spark, name, folder).totals()) == rebuilt(spark, products, heads, lines)


def test_refresh_touches_the_months_of_the_delta_only(spark, name, shop_parts, tmp_path):
    products, heads, lines = shop_parts
    heads_ = spark.createDataFrame(heads, "order_id long, customer_id long, order_date date")
    folder = f"{tmp_path}/landing"
    land(spark, folder, lines)
    months = CustomerMonths(spark, name, folder)
    months.refresh(products, heads_)
    before = months.state.parts()
    land(spark, folder, [(6, 2, 4)])  # order 6 is of February
    done = months.refresh(products, heads_)
    after = months.state.parts()
    assert done.months == ("2024-02",)
    assert {k for k in before if before[k] != after[k]} == {"2024-02"}
    assert rows_of(months.totals()) == rebuilt(spark, products, heads, [*lines, (6, 2, 4)])


def test_refresh_that_dies_is_repeated_once(spark, name, shop_parts, tmp_path, monkeypatch):
    products, heads, lines = shop_parts
    heads_ = spark.createDataFrame(heads, "order_id long, customer_id long, order_date date")
    folder = f"{tmp_path}/landing"
    land(spark, folder, lines[:250])
    CustomerMonths(spark, name, folder).refresh(products, heads_)
    land(spark, folder, lines[250:])
    from cartwheel.plans import parts

    def lost(*a, **k):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(parts, "save_table", lost)  # all is written, nothing published
    with pytest.raises(RuntimeError):
        CustomerMonths(spark, name, folder).refresh(products, heads_)
    monkeypatch.undo()
    assert rows_of(CustomerMonths(spark, name, folder).totals()) == rebuilt(spark, products, heads, lines[:250])
    CustomerMonths(spark, name, folder).refresh(products, heads_)
    assert rows_of(CustomerMonths(spark, name, folder).totals()) == rebuilt(spark, products, heads, lines)


def test_refresh_rebuilds_when_a_file_is_gone(spark, name, shop_parts, tmp_path):
    products, heads, lines = shop_parts
    heads_ = spark.createDataFrame(heads, "order_id long, customer_id long, order_date date")
    folder = f"{tmp_path}/landing"
    land(spark, folder, lines)
    CustomerMonths(spark, name, folder).refresh(products, heads_)
    spark.createDataFrame(lines[:90], LINE).coalesce(1).write.mode("overwrite").parquet(folder)
    done = CustomerMonths(spark, name, folder).refresh(products, heads_)
    assert done.rebuilt
    assert rows_of(CustomerMonths(spark, name, folder).totals()) == rebuilt(spark, products, heads, lines[:90])


def test_jobs_from_refreshed_totals(spark, name, shop, tmp_path):
    """Both saved jobs give the same from the refreshed totals as from the lines."""
    folder = f"{tmp_path}/landing"
    lines = shop.orders.select("order_id", "product_id", "quantity")
    heads = shop.orders.select("order_id", "customer_id", "order_date").distinct()
    lines.coalesce(1).write.parquet(folder)
    months = CustomerMonths(spark, name, folder)
    months.refresh(shop.products, heads)
    for make in (etl.monthly_revenue_summary, etl.customer_360):
        assert rows_of(make(shop, customer_months=months.totals())) == rows_of(make(shop))
    assert output_root(spark)
