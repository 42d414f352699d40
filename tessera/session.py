"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime (broadcast when a
# side is measured small, split skewed partitions); dynamic partition overwrite
# is what makes the per-vintage replace touch only one partition.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffle partitions are sized at runtime: AQE coalesces small ones towards this
    # target and splits skewed ones, so a large spark.sql.shuffle.partitions on a
    # cluster costs nothing on small stages
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only when nothing is set and the
    master is local (tests) do we create one of our own. On a cluster a folder of the
    driver's machine would be a different one on every executor, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError(f"master {sc.master}: name a folder that all executors share in spark.checkpoint.dir")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for one run."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"

