"""Command-line entry for ``spark-submit`` (or ``python -m cartwheel``).

    zip -r cartwheel.zip cartwheel
    spark-submit --py-files cartwheel.zip submit.py run-all --data /path/to/tables
    python -m cartwheel job build_customer_360_sp --data /root/testdata/sf0.01 --local

The same job functions run from here, from tests and from the job
registry: they take the session, never build or stop one.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cartwheel.config import TESTDATA_PARAMS
from cartwheel.plans import etl
from cartwheel.queries import QUERIES, job_registry
from cartwheel.session import SCALE_CONF, cluster_conf, ensure_checkpoint_dir, local_session, set_defaults
from cartwheel.sources.tables import from_testdata


def _session(local: bool, data: str) -> SparkSession:
    if local:
        return local_session()
    spark = SparkSession.builder.appName("cartwheel").getOrCreate()
    set_defaults(spark, SCALE_CONF)  # what spark-submit --conf gives wins
    ensure_checkpoint_dir(spark)
    if not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        # no --conf given: size shuffles from the input volume and the cores
        # the cluster gave us
        sizing = cluster_conf(input_bytes(spark, data), spark.sparkContext.defaultParallelism)
        for key in ("spark.sql.shuffle.partitions",
                    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                    "spark.sql.adaptive.coalescePartitions.parallelismFirst"):
            set_defaults(spark, {key: sizing[key]})
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FileSystem summary)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser(prog="cartwheel")
    ap.add_argument("command", choices=["run-all", "job", "query"])
    ap.add_argument("name", nargs="?", help="job or query name")
    ap.add_argument("--data", required=True, help="directory holding the <table>.parquet files")
    ap.add_argument("--local", action="store_true", help="build a local[*] session")
    ap.add_argument("--out", help="for 'query': write the whole result as parquet here; without it a preview of 20 rows is printed")
    args = ap.parse_args(argv)

    spark = _session(args.local, args.data)
    if args.command == "run-all":
        result = etl.run_all(spark, from_testdata(spark, args.data), TESTDATA_PARAMS, show=True)
    elif args.command == "job":
        result = job_registry(args.data).call(spark, args.name).first()[0]
    else:
        df = QUERIES[args.name](spark, args.data)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
            result = f"wrote {args.name} to {args.out}"
        else:
            df.show(20, truncate=False)  # a preview, not the result
            result = f"showed the first rows of {args.name}"
    print(result)
    return result


if __name__ == "__main__":
    main()
