"""Session construction and table access.

Library code never creates its own session: operators receive DataFrames.
``build_session`` is for tests, the bench and local runs.  On a cluster the
session comes from the platform and ``spark.checkpoint.dir`` names a shared
folder; ``ensure_checkpoint_dir`` only falls back to a local scratch folder
when that setting is absent (tests, local mode).
"""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(master: str | None = None, app: str = "glossa",
                  shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus) * 2
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="glossa-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return local


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where it lies, if they see the same files and it isn't installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def artifact_path(spark: SparkSession, name: str, source: str) -> str:
    """Where this application keeps a copy made from ``source``: in the shared folder, the same for every caller.  (``glossa.artifacts`` has what others use, too.)"""
    key = hashlib.md5(source.encode()).hexdigest()[:12]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{spark.sparkContext.applicationId}-{key}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
