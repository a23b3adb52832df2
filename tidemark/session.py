"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster supplies its own."""
    os.environ.setdefault("TZ", "UTC")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine and vanish with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def keep(df: DataFrame, name: str) -> DataFrame:
    """Store a small intermediate table in the shared folder and read it back.

    Later steps then neither recompute it nor depend on its executors, and its
    file size is known to the planner before any join on it is planned.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared root; nothing is reused or deleted."""
    return f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
