"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "stopline") -> SparkSession:
    """A single-JVM session for tests and the bench. Clusters bring their own."""
    return prepare(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("STOPLINE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; safe to repeat on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")  # whole texts: a few MB a batch
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1024")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.stopline.local.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.stopline.local.dir", folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder."""
    return f"{shared_folder(spark)}/stopline/{name}-{uuid.uuid4().hex}"
