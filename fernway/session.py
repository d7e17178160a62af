"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; all of them may be changed on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows hold whole documents, so Python functions get them in small batches.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def local_session(app: str = "fernway", cpus: str = "8", **settings: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session somebody else built the SQL settings that it doesn't state itself, and
    send it this package. Meant to be called once, where the session enters."""
    for key, value in SQL_SETTINGS.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    return ship_package(spark)


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once, so that Python functions find it there."""
    context = spark.sparkContext
    if not any(f.endswith("/fernway.zip") for f in context.listFiles):
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(), "fernway"), "zip", os.path.dirname(package), "fernway"
        )
        context.addPyFile(archive)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local-mode session, where driver and executors share one machine,
    may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = tempfile.mkdtemp(prefix="fernway-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back."""
    path = new_work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
