"""Sessions and as-of joins against plain versions, with one key holding a
third of all rows, across ranges and Arrow batches."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cartwheel.operators.ordered import asof_join, sessions, with_session_start

T0 = dt.datetime(2024, 3, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def plain_sessions(rows, gap):
    out = []
    keys = sorted({k for k, _, _ in rows}, key=repr)
    for k in keys:
        times = sorted((t, i) for kk, t, i in rows if kk == k and t is not None)
        start = before = None
        for t, i in times:
            if before is None or t - before > gap:
                start = t
            out.append((k, t, i, start))
            before = t
    return sorted(((k, at(t), i, at(s)) for k, t, i, s in out), key=repr)


def check_sessions(spark, rows, gap, kind="timestamp_ntz", key="long"):
    df = spark.createDataFrame([(k, at(t), i) for k, t, i in rows], f"user {key}, t {kind}, i long").repartition(5)
    got = with_session_start(df, "user", "t", gap * 60)
    assert got.dtypes == [("user", "bigint" if key == "long" else key), ("t", kind), ("i", "bigint"), ("session_start", kind)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_sessions(rows, gap)


@pytest.fixture(params=["one batch", "tiny batches"])
def batches(request, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000 if request.param == "one batch" else 3)
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("gap", [0, 2, 7, 500])
def test_sessions_with_a_hot_user(spark, batches, gap):
    rnd = random.Random(gap)
    rows = [(1 if i % 3 == 0 else rnd.choice([None, 2, 3, 4, 5]), rnd.choice([None, *range(0, 900)]) if i % 9 == 1 else rnd.randrange(900), i)
            for i in range(240)]
    check_sessions(spark, rows, gap)


def test_one_session_over_many_ranges(spark, batches):
    check_sessions(spark, [(7, i, i) for i in range(200)] + [(8, 5, 500), (6, 5, 501)], 1)
    check_sessions(spark, [(None, i // 20, i) for i in range(120)], 1, kind="timestamp")
    check_sessions(spark, [("a" if i % 2 else "b", i, i) for i in range(100)], 2, key="string")


def test_sessions_of_nothing(spark):
    check_sessions(spark, [], 1)
    check_sessions(spark, [(1, None, 1)], 1)
    with pytest.raises(ValueError):
        with_session_start(spark.createDataFrame([(1, T0, T0)], "user long, t timestamp, session_start timestamp"), "user", "t", 1)


def test_session_aggregates(spark):
    df = spark.createDataFrame([(1, at(0), 2), (1, at(1), 3), (1, at(9), 4), (2, at(1), 5)], "user long, t timestamp_ntz, v long")
    got = sorted(tuple(r) for r in sessions(df, "user", "t", 120, F.sum("v").alias("v")).collect())
    assert got == [(1, at(0), at(1), 2, 5), (1, at(9), at(9), 1, 4), (2, at(1), at(1), 1, 5)]


def plain_asof(left, right, within):
    out = []
    for k, t, i in left:
        fits = [(rt, a, b) for rk, rt, a, b in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        best = max(fits, key=lambda r: (r[0], r[1], (r[2] is not None, r[2] or "")), default=None)
        if best and within is not None and t - best[0] > within:
            best = None
        out.append((k, at(t), i, *((at(best[0]), best[1], best[2]) if best else (None, None, None))))
    return sorted(out, key=repr)


def check_asof(spark, left, right, within=None, kind="timestamp_ntz", key="long"):
    a = spark.createDataFrame([(k, at(t), i) for k, t, i in left], f"user {key}, t {kind}, i long").repartition(3)
    b = spark.createDataFrame([(k, at(t), x, y) for k, t, x, y in right], f"user {key}, seen {kind}, x long, y string").repartition(4)
    seconds = None if within is None else within * 60
    want = plain_asof(left, right, within)
    got = asof_join(a, b, "user", "t", "seen", within_seconds=seconds)
    assert got.dtypes == [*a.dtypes, *b.dtypes[1:]]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    inner = asof_join(a, b, "user", "t", "seen", how="inner", within_seconds=seconds)
    assert sorted((tuple(r) for r in inner.collect()), key=repr) == [r for r in want if r[3] is not None]


@pytest.mark.parametrize("within", [None, 0, 5])
def test_asof_with_a_hot_user(spark, batches, within):
    rnd = random.Random(3)
    some = lambda n: [(1 if i % 3 == 0 else rnd.choice([None, 2, 3, 4]), rnd.choice([None, *range(300)]) if i % 9 == 1 else rnd.randrange(300), i)
                      for i in range(n)]
    check_asof(spark, some(200), [(k, t, i % 4, rnd.choice([None, "a", "b"])) for k, t, i in some(150)], within)


def test_asof_carries_over_whole_ranges(spark, batches):
    # one early match for all rows of a key, far behind it in other ranges
    check_asof(spark, [(2, 10 + i, i) for i in range(150)] + [(1, 5, 900), (3, 9, 901)], [(2, 0, 1, "only"), (1, 6, 2, "late")])
    check_asof(spark, [("k", 10 + i, i) for i in range(90)], [("k", 3, 1, None)], kind="timestamp", key="string")


def test_asof_of_nothing(spark):
    check_asof(spark, [], [])
    check_asof(spark, [(1, 1, 1)], [])
    check_asof(spark, [], [(1, 1, 1, "a")])
    with pytest.raises(ValueError):
        asof_join(spark.createDataFrame([(1, T0)], "user long, t timestamp"), spark.createDataFrame([(1, T0)], "user long, t timestamp"), "user", "t", "t")
