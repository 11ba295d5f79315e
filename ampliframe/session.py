"""Session settings the library relies on, and where it may write scratch data."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # lets the FASTQ source take over filters
    "spark.sql.python.filterPushdown.enabled": "true",
    # Sequences are wide rows: keep one Arrow batch small enough for a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def local_session(cores: str | int = "*", app: str = "ampliframe", **conf: str) -> SparkSession:
    """A session for one machine; on a cluster pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SESSION_CONF,
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers of a session, once.

    Not needed where it is installed on the executors or given with --py-files.
    """
    context = spark.sparkContext
    name = "ampliframe_shipped.zip"
    if any(os.path.basename(f) == name for f in context._python_includes):
        return spark
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="spark-"), name)
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a fresh one where none is set (tests)."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    context.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Store `df` once so that costly work below it is not repeated; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
