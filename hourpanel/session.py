"""Session settings and written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "hourpanel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the zone pinned to UTC. Sizing (executors, memory) belongs to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own, removed at exit. On a
    cluster a missing setting is an error, because executors cannot see a driver-local folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="hourpanel-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, grouped by application so a run can be purged."""
    return "/".join(
        [
            checkpoint_root(spark).rstrip("/"),
            f"hourpanel-{spark.sparkContext.applicationId}",
            f"{name}-{uuid.uuid4().hex}",
        ]
    )


def release(spark: SparkSession) -> None:
    """Delete what this application wrote below the checkpoint folder; call it when results are written."""
    own = f"{checkpoint_root(spark).rstrip('/')}/hourpanel-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    This cuts the lineage (a lost executor re-reads files, not the whole upstream plan), makes later
    passes prune columns, and gives the planner a real file size: a side smaller than
    ``spark.sql.autoBroadcastJoinThreshold`` is then broadcast, a larger one is sort-merge joined.
    No join in this package carries a broadcast hint.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
