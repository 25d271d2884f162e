"""Sessions and shared folders."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(name: str, cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitter configures it.

    Spark's debugging aid that records the Python line of every column is off:
    it takes as long as all other plan building together.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new subfolder of the cluster's shared folder, ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/reports-{uuid.uuid4().hex}"
