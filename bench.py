"""Time every registered query on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected). One untimed warm-up pass, then
``BENCH_RUNS`` timed passes; a query's time is the median of its passes.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.session import local_session  # noqa: E402
from cartwheel.queries import QUERIES  # noqa: E402

HEADLINE = ["revenue_by_region", "top_products", "monthly_revenue_summary", "customer_360",
            "customer_tiers", "customer_tiers_udf", "customer_discounts"]


def commit_id() -> str | None:
    """The measured code's git commit, for comparing numbers across rounds."""
    import subprocess
    try:
        out = subprocess.run(["git", "rev-parse", "--short", "HEAD"], capture_output=True, text=True,
                             cwd=os.path.dirname(os.path.abspath(__file__)), timeout=10)
        return out.stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        return None


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(QUERIES)

    scratch = tempfile.mkdtemp(prefix="cartwheel-bench-")
    spark = local_session(
        cpus, shuffle_partitions=cpus * 2, app_name="cartwheel-bench",
        extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
               "spark.checkpoint.dir": f"{scratch}/checkpoints"})

    errors: dict[str, str] = {}
    for name in names:  # warm-up: JIT, Python workers, file listing caches
        try:
            run_once(spark, QUERIES[name], sf_dir)
        except Exception as exc:  # keep timing the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    ok = [n for n in names if n not in errors]
    timings: dict[str, list[float]] = {name: [] for name in ok}
    order = random.Random(0)
    for _ in range(runs):  # another order per pass: no query always runs behind the same one
        for name in order.sample(ok, len(ok)):
            timings[name].append(run_once(spark, QUERIES[name], sf_dir))
    per_query = {name: round(statistics.median(ts), 4) for name, ts in timings.items()}
    headline = {n: per_query[n] for n in HEADLINE if n in per_query}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 4),
        "unit": "sec",
        "queries": per_query,
        "headline": headline,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": cpus * 2,
        "spark": spark.version,
        "python": sys.version.split()[0],
        "errors": errors,
        "commit": commit_id(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
