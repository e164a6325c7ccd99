"""Session helpers.

Library functions never create or stop a session: they take the caller's
``SparkSession``. :func:`local_session` is for tests, the bench and the
``spark-submit`` entry; on a cluster the submitter's settings win.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes (a
# dimension that turns out small is broadcast, a large one stays sort-merge),
# coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the split costs an extra shuffle: one key
    # may hold a third of all rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # plan-time broadcast checks read compressed parquet sizes; scale them
    # up so a dimension is only broadcast when its decoded size fits (AQE's
    # runtime check then uses the real bytes)
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Local runs only: tiny shuffles would otherwise be coalesced below one task
# per core (the default 1 MB floor), serialising the reduce side.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20,
                 max_partitions: int | None = None) -> dict[str, str]:
    """Size shuffles for a cluster run (pass the result as ``--conf``).

    The initial shuffle partition count aims at about ``target_partition_bytes``
    of input per partition, at least two per core. AQE then coalesces toward
    the 128 MB advisory size, so a partition never has to hold more than a
    bounded slice in executor memory. ``max_partitions`` limits the count where
    the driver's map-output metadata must stay small; partitions then grow
    beyond the target. No limit by default. Scan splits stay at 128 MB."""
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    if max_partitions is not None:
        partitions = min(partitions, max_partitions)
    return {
        **SCALE_CONF,
        # on a shared cluster coalesce to the advisory size, not to maximum
        # parallelism (fewer, fuller tasks)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": "128m",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cartwheel", extra: dict | None = None) -> SparkSession:
    """A local session configured like the cluster one, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (local tests) create a
    scratch one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def output_root(spark: SparkSession) -> str:
    """Root of saved tables: the warehouse directory.

    On a cluster it must be shared storage. Spark's default is a local folder
    under the working directory, on which every executor would write to its own
    disk: it is refused there unless ``spark.sql.warehouse.dir`` was given."""
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    given = spark.sparkContext.getConf().contains("spark.sql.warehouse.dir")
    if root.startswith(("file:", "/")) and not is_local(spark) and not given:
        raise RuntimeError("set spark.sql.warehouse.dir to a shared folder for cluster runs")
    return root


#: rows that a task sorts or aggregates, where their number is known beforehand
TASK_ROWS = 1 << 18


def task_count(spark: SparkSession, rows: int) -> int:
    """How many tasks ``rows`` are dealt over by ``repartition``: one a core,
    or more, so that none gets more than about TASK_ROWS. AQE joins small
    partitions until there is one a core, or by their compressed bytes; either
    lets the memory of a task grow with the table."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def set_defaults(spark: SparkSession, defaults: dict[str, str]) -> None:
    """Apply SQL settings that neither the submitter nor the session has set."""
    submitted = spark.sparkContext.getConf()
    for key, value in defaults.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
