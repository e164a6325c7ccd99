"""Print the formatted physical plan of queries, after running them once so
the adaptive plan shown is the final one.

    python tools/explain_plans.py /root/testdata/sf0.1 revenue_by_region top_products
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.queries import QUERIES  # noqa: E402
from cartwheel.session import local_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="cartwheel-explain-")
    spark = local_session(8, 16, extra={"spark.sql.warehouse.dir": f"{scratch}/warehouse",
                                        "spark.checkpoint.dir": f"{scratch}/checkpoints"})
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # run this very plan, so AQE prints its final form
        print(f"##### {name}")
        df.explain(mode="formatted")
    spark.stop()


if __name__ == "__main__":
    main()
