"""Interval joins, exact percentiles, lattice cubes, heavy hitters and
sketches against plain versions, with one key or bin holding a third of all."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import math
import random
from collections import Counter, defaultdict
from decimal import Decimal
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.cube import cube_sets, lattice, rollup_sets
from cartwheel.operators.heavy import MisraGries, heavy_hitters, summaries
from cartwheel.operators.intervals import overlap_join
from cartwheel.operators.percentiles import percentiles
from cartwheel.operators.sketches import error_bound, estimate, levels, roll_up, sketch_state


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ----------------------------------------------------------------- intervals
def plain_overlaps(left, right):
    return sorted(((k, a, b, i, c, d, j) for k, a, b, i in left for kk, c, d, j in right
                   if k is not None and k == kk and None not in (a, b, c, d) and a <= b and c <= d and a <= d and c <= b), key=repr)


def intervals(rnd, n, keys, longest):
    out = []
    for i in range(n):
        a = rnd.choice([None, *range(-300, 300)]) if i % 17 == 0 else rnd.randrange(-300, 300)
        out.append((rnd.choice(keys), a, None if a is None else a + rnd.choice([-2, 0, 1, rnd.randrange(longest)]), i))
    return out


@pytest.mark.parametrize("longest,width,hot", [(5, 16, 10**6), (40, 4, 3), (5000, 2, 5), (300, 1, 10**6)])
def test_overlaps(spark, longest, width, hot):
    rnd = random.Random(longest)
    left, right = intervals(rnd, 150, [None, 1, 1, 2], longest), intervals(rnd, 120, [None, 1, 2, 2], longest)
    a = spark.createDataFrame(left, "k int, s long, e long, i int").repartition(3)
    b = spark.createDataFrame(right, "k int, from long, to long, j int").repartition(3)
    got = overlap_join(a, b, ("s", "e"), ("from", "to"), ["k"], width, hot)
    assert got.columns == ["k", "s", "e", "i", "from", "to", "j"]
    assert rows_of(got) == plain_overlaps(left, right)


def test_overlaps_of_dates_without_keys_and_of_nothing(spark):
    d = lambda x: dt.date(2024, 1, 1) + dt.timedelta(days=x)
    rnd = random.Random(1)
    left = [(d(a), d(a + rnd.randrange(50)), i) for i, a in enumerate(rnd.randrange(200) for _ in range(60))]
    a = spark.createDataFrame(left, "s date, e date, i int")
    b = a.withColumnsRenamed({"s": "s2", "e": "e2", "i": "i2"})  # the same rows
    want = sorted(((*x, *y) for x in left for y in left if x[0] <= y[1] and y[0] <= x[1]), key=repr)
    assert rows_of(overlap_join(a, b, ("s", "e"), ("s2", "e2"), width=8, hot_rows=4)) == want
    assert rows_of(overlap_join(a.limit(0), b, ("s", "e"), ("s2", "e2"))) == []
    assert rows_of(overlap_join(a, b.limit(0), ("s", "e"), ("s2", "e2"))) == []
    with pytest.raises(ValueError):
        overlap_join(a, a, ("s", "e"), ("s", "e"))
    with pytest.raises(TypeError):
        overlap_join(a.withColumn("s", F.lit("x")), b, ("s", "e"), ("s2", "e2"))


def test_a_hot_bin_is_dealt_over_many_keys(spark):
    """Two thirds of the left rows in one bin: no key of the join has more than hot_rows of them."""
    a = spark.range(3000).select(F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id") * 50).alias("s"), F.col("id").alias("i")).withColumn("e", F.col("s") + 1)
    b = spark.createDataFrame([(6, 9, 1), (1000, 1400, 2)], "s2 long, e2 long, j int")
    got = overlap_join(a, b, ("s", "e"), ("s2", "e2"), width=16, hot_rows=100)
    assert got.groupBy("j").count().orderBy("j").collect()[0]["count"] == 2000
    assert got.count() == 2000 + a.filter("s <= 1400 and 1000 <= e").count()


# --------------------------------------------------------------- percentiles
def plain_disc(values, p):
    v = sorted(values)
    return v[max(1, math.ceil(p * len(v))) - 1]


def check_percentiles(spark, rows, kind, ranks, slices=1024):
    df = spark.createDataFrame(rows, f"g string, x {kind}").repartition(4)
    groups = defaultdict(list)
    for g, x in rows:
        if x is not None:
            groups[g].append(x)
    want = sorted(((g, len(v), *(plain_disc(v, p) for p in ranks.values())) for g, v in groups.items()), key=repr)
    assert rows_of(percentiles(df, ["g"], "x", ranks, slices)) == want


RANKS = {"least": 0.0, "p10": 0.1, "median": 0.5, "p99": 0.99, "most": 1.0}


@pytest.mark.parametrize("slices", [2, 3, 1024])
def test_percentiles_with_a_hot_group(spark, slices):
    rnd = random.Random(slices)
    rows = [("hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 7, rnd.randrange(-10**6, 10**6)])) for i in range(200)]
    check_percentiles(spark, rows, "long", RANKS, slices)


def test_percentiles_of_all_kinds(spark):
    rnd = random.Random(4)
    check_percentiles(spark, [("a", Decimal(rnd.randrange(-10**9, 10**9)).scaleb(-4)) for _ in range(80)], "decimal(18,4)", RANKS)
    check_percentiles(spark, [("a", dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(900))) for _ in range(50)], "date", RANKS)
    check_percentiles(spark, [("a", x) for x in (-2**63, 2**63 - 1, 0, 5, 2**62, -2**62, 2**63 - 2)], "long", RANKS)
    check_percentiles(spark, [("a", 1), ("a", 2), ("b", None), ("c", 3)], "smallint", RANKS)
    check_percentiles(spark, [], "int", RANKS)
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    assert rows_of(percentiles(df, [], "x", {"median": 0.5})) == [(3, 2)]
    with pytest.raises(TypeError):
        percentiles(df.select(F.col("x").cast("double").alias("x")), [], "x", {"median": 0.5})
    with pytest.raises(ValueError):
        percentiles(df, [], "x", {"p": 1.5})


# --------------------------------------------------------------------- cubes
def plain_cube(rows, sets):
    out = []
    for s in sets:
        groups = defaultdict(list)
        for a, b, c, key, v in rows:
            groups[tuple(x if d in s else None for d, x in zip("abc", (a, b, c)))].append((key, v))
        if not rows and not s:
            groups[(None, None, None)] = []
        gid = sum(4 >> i for i, d in enumerate("abc") if d not in s)
        for g, members in groups.items():
            sums = [v for _, v in members if v is not None]
            out.append((*g, gid, sum(sums) if sums else None, len({k for k, _ in members if k is not None})))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sets", [cube_sets("abc"), rollup_sets("abc"), [("b",), ("a", "c")], [()]])
def test_lattice(spark, sets):
    rnd = random.Random(3)
    rows = [(rnd.choice("xy"), rnd.choice([None, "p", "q"]), rnd.randrange(3), 1 if i % 3 == 0 else rnd.choice([None, *range(9)]), rnd.choice([None, 1, 5]))
            for i in range(150)]
    for data in (rows, []):
        df = spark.createDataFrame(data, "a string, b string, c int, k long, v long")
        got = lattice(df, ["a", "b", "c"], "k", {"total": "v"}, sets, "keys")
        assert got.columns == ["a", "b", "c", "grouping_id", "total", "keys"]
        assert rows_of(got) == plain_cube(data, sets)


def test_lattice_tasks_do_not_grow(spark, monkeypatch):
    """What a task aggregates is bounded by TASK_ROWS, for the finest table and for all nodes above it."""
    from cartwheel import session
    from cartwheel.operators import cube

    largest = []

    def written(df, name, inner=cube.materialize):
        out, path = inner(df, name)
        if name == "lattice":
            largest.append(out.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0])
        return out, path

    monkeypatch.setattr(session, "TASK_ROWS", 1000, raising=False)
    monkeypatch.setattr(cube, "materialize", written)
    key = F.col("id") % 30_000
    df = spark.range(40_000).select(*[(F.col("id") % m).alias(d) for d, m in zip("abc", (2, 3, 5))], key.alias("k"), F.lit(1).alias("v"))
    got = lattice(df, ["a", "b", "c"], "k", {"total": "v"}, cube_sets("abc"), "keys", 40_000)
    assert {(r.grouping_id, r.total, r["keys"]) for r in got.filter("grouping_id in (3, 7)").collect()} == {(3, 20_000, 15_000), (7, 40_000, 30_000)}
    assert len(largest) == 7 and max(largest) < 1500


def test_sketch_query_deals_the_lines(spark, monkeypatch):
    """The join of lines and heads has as many tasks as their number asks for."""
    from cartwheel import analytics, session
    from cartwheel.config import TESTDATA_PARAMS

    finest = []
    monkeypatch.setattr(session, "TASK_ROWS", 2000, raising=False)
    monkeypatch.setattr(analytics, "lattice", lambda df, *a, inner=analytics.lattice: (finest.append(df), inner(df, *a))[1])
    analytics.distinct_products_sketch(spark, "/root/testdata/sf0.01", TESTDATA_PARAMS)
    per_task = finest[0].groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_task[0] < 3000 and per_task[1] == 60_000


def test_cube_base_deals_the_lines(spark, monkeypatch):
    from cartwheel import session
    from cartwheel.analytics import cube_base
    from cartwheel.sources.tables import from_testdata

    monkeypatch.setattr(session, "TASK_ROWS", 2000, raising=False)
    base = cube_base(from_testdata(spark, "/root/testdata/sf0.01"))
    per_task = base.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_task[0] < 3000 and per_task[1] == 60_000


def test_cube_base_on_messy_tables(spark, messy_shop):
    """Repeated customers and products, unknown ones, nulls: as from the row-level join."""
    from cartwheel.analytics import cube_base
    from cartwheel.operators.star import month_of, order_details
    from cartwheel.sources.tables import Shop

    o = messy_shop.orders.filter("order_id is not null")
    shop = Shop(messy_shop.customers, messy_shop.products, o, o.select("order_id", "product_id", "quantity"),
                o.select("order_id", "customer_id", "order_date"))
    keys = ["region", "category", "month", "customer_id"]
    got = cube_base(shop).groupBy(*keys).agg(F.sum("order_total"), F.sum("n"))
    plain = order_details(Shop(shop.customers, shop.products, o), with_customer_id=True).withColumn("customer_id", F.col("cust_id"))
    want = plain.groupBy("region", "category", month_of().alias("month"), "customer_id").agg(F.sum("order_total"), F.count(F.lit(1)))
    assert rows_of(got) == rows_of(want) and len(rows_of(want)) > 10


def test_cube_sets():
    assert sorted(cube_sets("ab")) == sorted([(), ("a",), ("b",), ("a", "b")]) and rollup_sets("ab") == [("a", "b"), ("a",), ()]


# -------------------------------------------------------------- heavy hitters
def test_misra_gries_bounds():
    rnd = random.Random(6)
    keys = [rnd.choice([1, 2, rnd.randrange(500)]) for _ in range(4000)]
    state = MisraGries(20)
    for at in range(0, 4000, 37):
        state.add(keys[at:at + 37], [1] * len(keys[at:at + 37]))
        assert len(state.counts) <= 20
    true = Counter(keys)
    assert state.taken <= 4000 / 21
    assert all(true[k] - state.taken <= state.counts.get(k, 0) <= true[k] for k in true)


@pytest.mark.parametrize("share", [0.34, 0.05, 0.011])
def test_heavy_hitters(spark, share):
    rnd = random.Random(9)
    rows = [("hot" if i % 3 == 0 else rnd.choice([None, "warm", f"k{rnd.randrange(400)}"]), rnd.choice([None, -1, 1, 4])) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, weight int").repartition(5)
    count = Counter(k for k, _ in rows if k is not None)
    assert rows_of(heavy_hitters(df, "key", share)) == sorted((k, n, 3000) for k, n in count.items() if n > share * 3000)
    heavy = Counter()
    for k, w in rows:
        heavy[k] += max(0, w or 0)
    total = sum(heavy.values())
    assert rows_of(heavy_hitters(df, "key", share, "weight")) == sorted((k, n, total) for k, n in heavy.items() if k is not None and n > share * total)


def test_heavy_hitters_state_is_bounded_and_odd_input(spark):
    df = spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).cast("long").alias("weight")).repartition(3)
    parts = summaries(df, "key", "weight", 10)
    assert parts.filter("key is not null").count() <= 3 * 10
    assert parts.agg(F.sum("total")).first()[0] == 20_000
    assert rows_of(heavy_hitters(df, "key", 0.2)) == []
    assert rows_of(heavy_hitters(df.limit(0), "key", 0.2)) == []
    assert rows_of(heavy_hitters(spark.createDataFrame([(None,), (None,)], "key int"), "key", 0.2)) == []
    with pytest.raises(ValueError):
        heavy_hitters(df, "key", 0.0)


# ------------------------------------------------------------------- sketches
def test_sketch_state_rolls_up(spark, tmp_path):
    rnd = random.Random(7)
    rows = [("hot" if i % 3 == 0 else rnd.choice("abc"), rnd.randrange(4), rnd.choice([None, *range(3000)])) for i in range(9000)]
    sketch_state(spark.createDataFrame(rows, "g string, m int, x long"), ["g", "m"], "x").write.parquet(f"{tmp_path}/state")
    state = spark.read.parquet(f"{tmp_path}/state")  # saved and read again
    for dims in (("g", "m"), ("g",), ("m",), ()):
        exact = defaultdict(set)
        for g, m, x in rows:
            if x is not None:
                exact[tuple(v for v, d in zip((g, m), "gm") if d in dims)].add(x)
        got = {tuple(r)[:-1]: r["n"] for r in roll_up(state, dims).select(*dims, estimate().alias("n")).collect()}
        assert got.keys() == exact.keys()
        for k, values in exact.items():
            assert abs(got[k] - len(values)) <= max(1.0, 4 * 1.04 / 64 * len(values))
    both = levels(state, [("g", "m"), ("g",), ()], ["g", "m"])
    assert Counter(r.level for r in both.select("level").collect()) == {"g_m": 16, "g": 4, "all": 1}


def test_sketch_of_nothing_and_small_state(spark):
    empty = spark.createDataFrame([(1, None), (2, None)], "g int, x long")
    assert rows_of(sketch_state(empty, ["g"], "x").select("g", estimate())) == [(1, 0), (2, 0)]
    assert rows_of(roll_up(sketch_state(empty.limit(0), ["g"], "x"), []).select(estimate())) == [(0,)]
    assert spark.range(1).select(error_bound(F.lit(1000)), error_bound(F.lit(3))).first()[:] == (65.0, 1.0)
    small = sketch_state(spark.range(800).select((F.col("id") % 200).alias("g"), F.col("id").alias("x")), ["g"], "x")
    assert small.agg(F.max(F.length("sketch"))).first()[0] <= 64
