"""The M-tree search against all inner products, over many shapes of tree."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import mtree
from cartwheel.llm.mtree import MTreeParams

SCHEMA = "vec_id long, embedding array<double>"
TINY = MTreeParams(page_rows=7, part_rows=40, query_block=9, root_page=3)


def plain(rows, every=50, k=5):
    points = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
                     if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for i, v in points:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in points if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def check(spark, rows, params, every=50, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("v", "dim", "region", "part", "block", "score", "rank"):
            df = df.selectExpr("*", f"'x' as {name}")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % every == 0, params).collect())
    assert got == plain(rows, every, params.k)


def cloud(n, dim, seed, centers=6):
    g = np.random.default_rng(seed)
    c = g.normal(size=(centers, dim))
    return [(i, [float(x) for x in (c[g.integers(centers)] + 0.1 * g.normal(size=dim))]) for i in range(n)]


@pytest.mark.parametrize("params", [MTreeParams(), TINY, MTreeParams(k=3, page_rows=1, part_rows=25, query_block=1, root_page=1, max_regions=4)])
def test_clusters_norms_and_copies(spark, params):
    rows = cloud(260, 6, 1)
    rows += [(1000 + i, [0.5, 0.25, 0.0, -1.0, 2.0, 0.125]) for i in range(130)]  # a third are copies
    rows += [(2000 + i, [x * 50 for x in v]) for i, v in cloud(40, 6, 2)]  # far larger norms
    check(spark, rows, params, every=10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 2.0]), (0, None), (50, [1.0, None]), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [1.0, 2.0]), (200, [1.0, 2.0]),
            (200, [3.0, -1.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [0.0, 0.0]), (250, [0.0, 0.0]), (300, []), (11, [2.0]), (350, [5.0, 1.0, 9.0]),
            (-50, [-1.0, -1.0]), (-3, [0.001, -0.001])]
    check(spark, rows, MTreeParams(), extra=True)
    check(spark, rows, TINY)
    check(spark, [], MTreeParams())
    check(spark, [(0, [1.0])], MTreeParams())
    check(spark, [(0, [1.0]), (1, [-2.0])], MTreeParams())
    check(spark, [(0, []), (1, [])], MTreeParams())


def test_scores_beyond_what_floats_hold(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1, 1) * 3e5 for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [2e5 + i / 256, 2e5, 2e5, 2e5]) for i in range(8)]  # scores that differ in their last bits
    check(spark, rows, TINY, every=5)
    wide = [(i, [v[0] * 30, *(x / 1000 for x in v[1:])]) for i, v in rows]  # a component of more than 4 bytes; scores fit a long
    check(spark, wide, TINY, every=5)


def test_bounds_leave_out_pages_and_rows():
    """Stored distances spare computations where the data have clusters."""
    rows = cloud(4000, 8, 3, centers=40)
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    space = mtree.Space(float((x.astype(float) ** 2).sum(axis=1).max()) + 1, 8)
    pages = [dict(zip(mtree._PAGE.names, p)) for p in mtree.bulk_load(0, np.arange(4000), x, space, 64)]
    assert sorted(np.concatenate([np.frombuffer(p["ids"], "<i8") for p in pages])) == list(range(4000))
    assert all(p["n"] <= 64 for p in pages)
    scored = []
    add = mtree.Found.add
    try:
        mtree.Found.add = lambda self, s, i: (scored.append(len(s)), add(self, s, i))[1]
        list(mtree.search_part(pages, x[:50], np.arange(50), [None] * 50, space, MTreeParams()))
    finally:
        mtree.Found.add = add
    assert sum(scored) < 0.5 * 50 * 4000
