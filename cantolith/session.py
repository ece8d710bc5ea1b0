"""Session defaults shared by the tests, the bench and interactive use."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "cantolith", cpus: int | None = None) -> SparkSession:
    """The session that there is, or that spark-submit made, with its settings; else a local one."""
    if active := SparkSession.getActiveSession():
        return active
    if "PYSPARK_GATEWAY_PORT" in os.environ:  # submitted: master, memory and partitions are the submitter's
        return SparkSession.builder.getOrCreate()
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CANTOLITH_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder's path for files that a query writes and reads again: in spark.checkpoint.dir, or a temporary one on a single machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{base or tempfile.mkdtemp(prefix='scratch-')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed and written to the session's checkpoint folder, with no lineage before it."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(scratch(df.sparkSession))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder, read by Spark alone."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
