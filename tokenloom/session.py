"""Session construction and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tokenloom",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # Small local inputs: keep enough partitions for CPU-heavy encoders.
         .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is used as is; without
    it this raises. Only a local run without the setting (tests) gets a
    scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not current:
        current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tokenloom-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder, unique per call."""
    import uuid
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
