"""Session settings for local runs and the shared scratch folder of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "amihan", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the bench.

    On a cluster the session comes from the submitter: AQE then sizes and
    splits shuffle partitions, and nothing here is needed.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # No call-site capture per column expression: it triples planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _fallback_root(spark: SparkSession) -> str:
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return tempfile.mkdtemp(prefix="amihan-")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_amihan"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and run tables.

    The cluster names it in ``spark.checkpoint.dir``.  Where that setting is
    absent a local session uses a temporary folder; on several machines the
    warehouse is used, which must not be a machine's own folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        root = configured or _fallback_root(spark)
        spark.sparkContext.setCheckpointDir(root)
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
