"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # grouping a union of joins must not rely on partitionings that change at run time
    "spark.sql.unionOutputPartitioning": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def session(app: str = "spark-curate", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a session that names none (a local test) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage of iterative operators. The written table survives the loss
    of executors, keeps columns prunable and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
