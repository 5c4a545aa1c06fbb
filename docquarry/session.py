"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings results depend on: dates are kept and compared in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or the checkpoint
    folder the application has set.

    Only a local master may go without one; it then gets a temporary folder of its
    own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="docquarry-"))
    return context.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Rows written once to a folder of their own in the shared folder, and read back."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
