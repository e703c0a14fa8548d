"""Session defaults for tests and benchmarks, and the shared scratch location.

The library never creates a session on import; production callers bring their own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "statforge", **conf: str) -> SparkSession:
    """A local session with the settings the tests and the benchmark rely on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Small local files: let every row group be a task, and skip call-site capture per column.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STATFORGE_DRIVER_MEMORY", "8g"))
    )
    settings = {key.replace("__", "."): value for key, value in conf.items()}
    # One machine: its own folder is shared by all its tasks.
    settings.setdefault("spark.checkpoint.dir", f"/tmp/{app}-{uuid.uuid4().hex}")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    There is no default: a folder of one machine would hide the files from the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that several later steps use: they are computed once, survive lost executors, and
    keep column pruning, unlike an RDD checkpoint.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
