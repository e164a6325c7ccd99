"""Edge vectors for the rules; native, Python, UDF and SQL twins agree."""

from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartwheel.config import PRICE_TIERS, REVENUE_TIERS, SPEND_TIERS
from cartwheel.functions import email, rules

SPEND = [(500.0, "Platinum"), (499.99, "Gold"), (200.0, "Gold"), (199.99, "Silver"), (100.0, "Silver"),
         (99.99, "Bronze"), (0.0, "Bronze"), (-1.0, "Bronze"), (None, "Bronze"), (math.nan, "Bronze")]
REVENUE = [(5000.01, "High"), (5000.0, "Medium"), (2000.01, "Medium"), (2000.0, "Low"), (None, "Low")]
PRICE = [(200.01, "Premium"), (200.0, "Standard"), (50.01, "Standard"), (50.0, "Budget"), (None, "Budget")]


@pytest.mark.parametrize("rule,cases", [(SPEND_TIERS, SPEND), (REVENUE_TIERS, REVENUE), (PRICE_TIERS, PRICE)])
def test_tier_twins(spark, rule, cases):
    df = spark.createDataFrame([(v,) for v, _ in cases], "v double")
    native = [r[0] for r in df.select(rules.tier_column("v", rule)).collect()]
    row_udf = [r[0] for r in df.select(rules.tier_udf(rule)("v")).collect()]
    arrow_udf = [r[0] for r in df.select(rules.tier_udf(rule, use_arrow=True)("v")).collect()]
    python = [rules.tier_of(v, rule) for v, _ in cases]
    expected = [t for _, t in cases]
    assert native == row_udf == arrow_udf == python == expected


def test_sql_function_probe(spark):
    rules.register_sql_functions(spark)
    got = spark.sql("SELECT 'Alice' AS name, discount_tier(350.0) AS a, discount_tier(150.0) AS b, "
                    "discount_tier(50.0) AS c, discount_tier(NULL) AS d").first()
    assert tuple(got) == ("Alice", "Gold", "Silver", "Bronze", "Bronze")


def test_python_function_registered_for_sql(spark):
    rules.register_python_functions(spark)
    got = spark.sql("SELECT discount_tier_py(350.0), calculate_discount_amount(1000.0, 'Gold')").first()
    assert got[0] == "Gold" and abs(got[1] - 100.0) < 1e-12


def test_rates(spark):
    df = spark.createDataFrame([("Platinum", 100.0), ("Gold", 100.0), ("Silver", 100.0),
                                ("Bronze", 100.0), ("Tin", 100.0), (None, 100.0), ("Gold", None)],
                               "tier string, spend double")
    native = [r[0] for r in df.select(rules.discount_amount_column("spend", "tier")).collect()]
    vec = [r[0] for r in df.select(rules.discount_amount_pandas_udf()("spend", "tier")).collect()]
    expected = [15.0, 10.0, 5.0, 0.0, 0.0, 0.0, None]
    assert native == expected
    assert vec == expected          # NaN from pandas arrives as NULL, like the native twin
    pdv = rules.discount_amounts(pd.Series([10.0, 10.0]), pd.Series(["Silver", "Unknown"]))
    assert list(pdv) == [0.5, 0.0]


DOMAINS = [("a@b.c", "b.c"), ("a@b@c", "b"), ("x@", ""), ("@y", "y"), ("", "unknown"),
           (None, "unknown"), ("noat", "unknown")]


def test_domain_twins(spark):
    df = spark.createDataFrame([(e,) for e, _ in DOMAINS], "e string")
    native = [r[0] for r in df.select(email.domain_column("e")).collect()]
    udf = [r[0] for r in df.select(email.domain_udf()("e")).collect()]
    assert native == udf == [email.domain_of(e) for e, _ in DOMAINS] == [d for _, d in DOMAINS]


def test_emails_in_whole_text(spark):
    text = ("write to ann.lee@example.org or bob@mail.co.uk; not@this or x@y.z. "
            + "filler " * 5000 + "last: zed+tag@far.example.com")
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [r[0] for r in df.select(F.explode(email.emails_in("text"))).collect()]
    assert got == ["ann.lee@example.org", "bob@mail.co.uk", "zed+tag@far.example.com"]


def test_persistent_sql_function(spark):
    name = rules.register_sql_functions(spark, database="fn_t")
    assert name == "fn_t.discount_tier"
    assert spark.sql("SELECT fn_t.discount_tier(600.0)").first()[0] == "Platinum"
    rules.register_sql_functions(spark, SPEND_TIERS.with_thresholds(1000.0, 500.0, 100.0), database="fn_t")
    assert spark.sql("SELECT fn_t.discount_tier(600.0)").first()[0] == "Gold"      # replaced


def test_udf_bodies_need_no_package_on_workers(tmp_path):
    """Executors may not have this package: the shipped functions must
    unpickle and run in a Python that cannot import it."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    probe = ("import pickle, sys\n"
             "tier, amounts, domain = pickle.loads(sys.stdin.buffer.read())\n"
             "import pandas as pd\n"
             "print(tier(600.0), list(amounts(pd.Series([100.0]), pd.Series(['Gold']))), domain('a@b.c'))\n")
    blob = cloudpickle.dumps((rules.tier_function(SPEND_TIERS), rules.discount_amount_function(),
                              email.domain_function()))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", probe], input=blob, cwd=tmp_path, env=env,
                         capture_output=True, timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-2000:]
    assert out.stdout.decode().split() == ["Platinum", "[10.0]", "b.c"]


def test_cluster_conf_sizes_partitions():
    from cartwheel.session import cluster_conf
    big = cluster_conf(100 * 2**40, 8000)                    # 100 TB on 1000 executors x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600              # 256 MB each, no silent limit
    assert int(cluster_conf(100 * 2**40, 8000, max_partitions=200_000)["spark.sql.shuffle.partitions"]) == 200_000
    mid = cluster_conf(10 * 2**40, 8000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 40_960
    small = cluster_conf(2**30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert big["spark.sql.adaptive.enabled"] == "true"


def test_linear_email_pattern_matches_original(spark):
    """The linear-time pattern finds exactly what the portable one finds
    (both run by Spark's Java regex; Python's re as a third opinion)."""
    import random
    import re

    from cartwheel.config import EMAIL_PATTERN

    rng = random.Random(7)
    alphabet = "ab1.-_%+@@ X=.z"
    texts = ["x@a.bc1y@d.ef", "a@b.cc.d@e.ff", "aa@bb@cc.dd", "@@a@b.cd", "a.b@c.d.ee.f@g.hh",
             "q@w.er" * 5, "x" * 300 + "@" + "y" * 300, "a@" + ".b" * 200, ""]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = df.select("i", email.emails_in("text").alias("fast"),
                    email.emails_in("text", EMAIL_PATTERN).alias("plain")).collect()
    for row in got:
        expected = re.findall(EMAIL_PATTERN, texts[row.i])
        assert row.fast == row.plain == expected, texts[row.i]


def test_linear_email_pattern_on_long_runs(spark):
    import time
    text = "write to a@b.cc " + "x" * 200_000 + " or " + "y" * 100_000 + "@"
    df = spark.createDataFrame([(text,)], "text string")
    t0 = time.perf_counter()
    assert df.select(email.emails_in("text")).first()[0] == ["a@b.cc"]
    assert time.perf_counter() - t0 < 30      # the portable pattern needs many minutes here
