"""Saved jobs: overwrite semantics, rerun safety, read-back counts, the
registry, the orchestrator and the raw layer."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.config import Params
from cartwheel.plans import etl
from cartwheel.plans.registry import JobRegistry
from cartwheel.plans.sink import save_table
from cartwheel.sources.catalog import load_raw_tables
from cartwheel.sources.tables import from_catalog

P = Params(analytics_db="analytics_t", raw_db="raw_t")


def test_monthly_summary_job_twice(spark, shop):
    first = etl.build_monthly_revenue_summary(spark, shop, P)
    second = etl.build_monthly_revenue_summary(spark, shop, P)
    assert first == second == "SUCCESS: Saved 8 rows to analytics_t.monthly_revenue_summary"
    saved = spark.table("analytics_t.monthly_revenue_summary")
    assert saved.columns == ["region", "month", "total_revenue", "order_count", "avg_order_value",
                             "unique_customers", "revenue_tier"]
    assert {r[0] for r in saved.select("revenue_tier").distinct().collect()} == {"Low"}
    sample = etl.monthly_summary_sample(spark, P).collect()
    assert [(r.month.isoformat(), r.region) for r in sample][:3] == [
        ("2024-01-01", "North"), ("2024-01-01", "South"), ("2024-02-01", "North")]


def test_overwrite_replaces_schema(spark, shop):
    etl.build_monthly_revenue_summary(spark, shop, P)
    df = spark.table("analytics_t.monthly_revenue_summary").drop("unique_customers")
    save_table(etl.monthly_revenue_summary(shop, P, with_unique_customers=False),
               "analytics_t.monthly_revenue_summary")
    assert "unique_customers" not in spark.table("analytics_t.monthly_revenue_summary").columns
    assert spark.table("analytics_t.monthly_revenue_summary").count() == df.count()
    etl.build_monthly_revenue_summary(spark, shop, P)
    assert "unique_customers" in spark.table("analytics_t.monthly_revenue_summary").columns


def test_customer_360_job(spark, shop):
    assert etl.build_customer_360(spark, shop, P) == "SUCCESS: Saved 5 rows to analytics_t.customer_360"
    saved = spark.table("analytics_t.customer_360")
    assert saved.columns == ["customer_id", "first_name", "last_name", "email", "region", "signup_date",
                             "total_spend", "order_count", "avg_order_value", "discount_tier"]
    assert saved.filter(F.col("customer_id") == 5).count() == 0        # no orders -> absent
    top = [r.customer_id for r in etl.top_spenders(spark, P).collect()]
    assert top == [1, 6, 3, 2, 4]


def test_customer_360_order_dates(shop):
    got = {r.customer_id: (r.first_order_date.isoformat(), r.last_order_date.isoformat())
           for r in etl.customer_360(shop, P, with_order_dates=True).collect()}
    assert got[1] == ("2024-01-15", "2024-01-20")


def test_registry(spark, shop):
    reg = JobRegistry()
    reg.register("build_monthly_revenue_summary_sp", lambda s: etl.build_monthly_revenue_summary(s, shop, P))
    with pytest.raises(ValueError):
        reg.register("build_monthly_revenue_summary_sp", lambda s: "x")
    reg.register("build_monthly_revenue_summary_sp", lambda s: etl.build_monthly_revenue_summary(s, shop, P),
                 replace=True)
    status = reg.call(spark, "BUILD_MONTHLY_REVENUE_SUMMARY_SP").collect()
    assert status[0][0] == "SUCCESS: Saved 8 rows to analytics_t.monthly_revenue_summary"
    with pytest.raises(KeyError):
        reg.call(spark, "nope")


def test_run_all(spark, shop):
    assert etl.run_all(spark, shop, P) == (
        "Pipeline complete. SUCCESS: Saved 8 rows to analytics_t.monthly_revenue_summary | "
        "SUCCESS: Saved 5 rows to analytics_t.customer_360")


def test_raw_layer_round_trip(spark, shop):
    raw = load_raw_tables(spark, shop, P.raw_db, P.analytics_db)
    assert raw.orders.count() == 11 and raw.customers.count() == 6 and raw.products.count() == 5
    assert dict(raw.products.dtypes)["unit_price"] == "decimal(10,2)"
    again = from_catalog(spark, P.raw_db)
    assert etl.build_customer_360(spark, again, P) == "SUCCESS: Saved 5 rows to analytics_t.customer_360"


def test_versions_pruned_and_new_session_rerun(spark, shop):
    import glob
    import os

    from cartwheel.session import output_root
    for _ in range(3):
        etl.build_customer_360(spark, shop, P)
    table_dir = output_root(spark).removeprefix("file:") + "/analytics_t.db/customer_360"
    assert len([d for d in os.listdir(table_dir) if d.startswith("v-")]) == 2
    live = spark.sql("DESCRIBE TABLE EXTENDED analytics_t.customer_360").filter("col_name = 'Location'").first()[1]
    assert os.path.basename(live) == sorted(d for d in os.listdir(table_dir) if d.startswith("v-"))[-1]
    assert glob.glob(table_dir + "/v-*/*.parquet")

    fresh = spark.newSession()
    assert etl.build_customer_360(fresh, shop, P) == "SUCCESS: Saved 5 rows to analytics_t.customer_360"
    assert fresh.table("analytics_t.customer_360").count() == 5


def test_summary_and_region_totals_agree(spark, shop):
    from cartwheel.operators import reports as R
    summary = etl.monthly_revenue_summary(shop, P).agg(F.sum("total_revenue"), F.sum("order_count")).first()
    region = R.revenue_by_region(shop).agg(F.sum("total_revenue"), F.sum("order_count")).first()
    assert tuple(summary) == tuple(region)


def test_bucketed_raw_layer_needs_no_customer_exchange(spark):
    """orders and customers bucketed alike on customer_id: the per-customer
    aggregate and the customer join read co-located data (products, a small
    catalogue, is broadcast)."""
    import contextlib
    import datetime as dt
    import io
    from decimal import Decimal

    from cartwheel.sources.catalog import frames_from_rows

    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.enabled", "false")
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024))   # products yes, customers no
    customers = [(i, f"n{i}", "x", f"u{i}@shop.example", ["North", "South"][i % 2], None)
                 for i in range(1, 4001)]
    products = [(p, f"p{p}", "A", Decimal("2.00")) for p in range(1, 6)]
    orders = [(i, (i * 7) % 4000 + 1, i % 5 + 1, 1 + i % 3, dt.date(2024, 1 + i % 12, 3)) for i in range(12000)]
    shop = frames_from_rows(s, customers, products, orders)
    raw = load_raw_tables(s, shop, "raw_bk", "analytics_bk", buckets=8)
    raw = load_raw_tables(s, shop, "raw_bk", "analytics_bk", buckets=8)          # rerun publishes again

    plain, bucketed = etl.customer_360(shop, P), etl.customer_360(raw, P)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, bucketed.collect()))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        bucketed.explain()
    text = buf.getvalue()
    assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text


def test_approx_distinct_opt_in(shop):
    exact = {(r.region, r.month): r.unique_customers for r in etl.monthly_revenue_summary(shop, P).collect()}
    approx = {(r.region, r.month): r.unique_customers
              for r in etl.monthly_revenue_summary(shop, P, approx_distinct_rsd=0.01).collect()}
    assert approx == exact          # tiny groups: HyperLogLog++ is exact here


def test_run_all_shares_and_removes_its_intermediate(spark, shop):
    import os

    from cartwheel.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert etl.run_all(spark, shop, P).startswith("Pipeline complete. SUCCESS: Saved 8 rows")
    after = set(os.listdir(base)) if os.path.isdir(base) else set()
    assert not {d for d in after - before if d.startswith("customer_months-")}


def test_reload_without_buckets_replaces_the_layout(spark):
    """A bucketed table saved again without buckets must lose the bucket spec."""
    import datetime as dt
    from decimal import Decimal

    from cartwheel.plans.sink import published
    from cartwheel.sources.catalog import frames_from_rows

    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.enabled", "false")
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024))
    customers = [(i, f"n{i}", "x", f"u{i}@shop.example", "North", None) for i in range(1, 4001)]
    products = [(p, f"p{p}", "A", Decimal("2.00")) for p in range(1, 6)]
    orders = [(i, (i * 7) % 4000 + 1, i % 5 + 1, 1, dt.date(2024, 1 + i % 12, 3)) for i in range(8000)]
    shop = frames_from_rows(s, customers, products, orders)
    want = sorted(map(tuple, etl.customer_360(shop, P).collect()))
    for buckets in (8, 0, 4, 4):
        raw = load_raw_tables(s, shop, "raw_rb", "analytics_rb", buckets=buckets)
        spec = published(s, "raw_rb.orders").buckets
        assert (spec is None) == (buckets == 0) and (not spec or spec[0] == str(buckets))
        assert sorted(map(tuple, etl.customer_360(raw, P).collect())) == want


def test_failed_write_does_not_remove_the_version_readers_use(spark):
    table = "analytics_f.t"
    save_table(spark.range(5), table)
    reader = spark.table(table)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    for _ in range(3):
        with pytest.raises(Exception):
            save_table(bad, table)
    save_table(spark.range(7), table)
    assert reader.count() == 5 and spark.table(table).count() == 7
    save_table(spark.range(9), table)
    assert spark.table(table).count() == 9


def test_new_files_are_seen_during_a_session(spark, tmp_path):
    import shutil

    from conftest import SF0001

    from cartwheel.sources.tables import from_testdata
    for name in ("region", "nation", "customer", "part", "orders", "lineitem"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copy(f"{SF0001}/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    before = from_testdata(spark, str(tmp_path)).customers.count()
    shutil.copy(f"{SF0001}/customer.parquet", tmp_path / "customer.parquet" / "b.parquet")
    assert from_testdata(spark, str(tmp_path)).customers.count() == 2 * before


def test_frames_outlive_the_other_queries(spark):
    """All frames first, then all results: no query overwrites another's table."""
    from conftest import SF0001

    from cartwheel.queries import QUERIES
    names = ["monthly_revenue_summary", "monthly_summary_sample", "customer_360", "top_spenders", "raw_orders",
             "call_registered_job", "run_all_jobs", "run_all_customer_360", "load_raw_tables"]
    frames = {n: QUERIES[n](spark, SF0001) for n in names}
    assert all(f.collect() for f in frames.values())
