"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Folders made for local runs, one per Spark application.
_local_dirs: dict[str, str] = {}


def get_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """Session with the settings the models rely on: UTC, ANSI, AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Sliding frames cost time, not bytes: keep small shuffles in parallel.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local master may go without the setting; it gets a folder of its
    own, removed when the process ends.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, in one folder per application.

    What an application leaves there may go once it has ended.
    """
    app = spark.conf.get("spark.app.id")
    return f"{shared_dir(spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Besides cutting lineage this gives the planner the real size of the data,
    so that joins against it are broadcast only below Spark's own threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
