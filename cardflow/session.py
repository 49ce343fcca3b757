"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings the jobs are designed for (also on a cluster): adaptive execution with skew splitting,
# also where a split join feeds an aggregate that would otherwise reuse the join's partitioning
# (AQE then adds the exchange above the partial aggregate), and JIT-friendly code generation.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",  # days and months of zoned timestamps don't depend on the cluster
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a fused stage whose method exceeds the JVM's 8000-byte JIT limit runs interpreted;
    # at this limit Spark compiles such stages operator by operator instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_recommended_conf(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cardflow") -> SparkSession:
    """Session for tests and the local bench. On a cluster use the session the job is given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        # Skip capturing a Python call site for every Column call (error-context only): plans
        # with hundreds of expressions are built several times faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CARDFLOW_DRIVER_MEMORY", "8g"))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a private folder; a cluster session without
    one is a configuration error, because a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="cardflow-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path for job-owned tables under the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), "cardflow", *parts])
