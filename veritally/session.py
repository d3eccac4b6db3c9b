"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and the benchmark.

    A cluster brings its own session: nothing in the library depends on these
    settings, except that ANSI mode and AQE are Spark's defaults and stay on.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("veritally")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root of the folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a folder of this machine; a cluster without the setting is a
    mistake that should show at once, not when the first executor is lost.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="veritally-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between runs."""
    return f"{shared_folder(spark).rstrip('/')}/veritally/{name}-{uuid.uuid4().hex}"


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows starts from the files: it cannot come out differently when a
    part is computed again, and a lost executor costs none of the work before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too."""
    root, found = str(Path(__file__).parents[1]), spark.sparkContext.environment
    paths = [p for p in found.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        found["PYTHONPATH"] = os.pathsep.join([root, *paths])


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, and with it what finished jobs have left.

    Spark frees plans, broadcasts and shuffle files of tables that nobody refers to only then. A loop
    of small jobs makes little garbage on the heap and so leaves many of them behind.
    """
    spark.sparkContext._jvm.System.gc()
