"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "readframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on (AQE, UTC, skew-join handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the session names none (a local test run) is a temporary folder made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage (survives executor loss)."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, for wide rows that several steps read: each reads its columns.

    A checkpoint holds whole rows as they are in memory.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of ended steps deleted: else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.range(1).count()  # Spark holds the plan that ran last
    spark.sparkContext._jvm.System.gc()
