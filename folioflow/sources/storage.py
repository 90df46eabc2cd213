"""Shared working storage named by the session."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; choose one only where none is set and Spark is local."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="folioflow-checkpoint-")
    context.setCheckpointDir(named)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared working folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write the rows as parquet to the shared folder and read on from there. What it wrote
    stays, since frames that read it may be used later."""
    path = shared_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


@contextmanager
def staging(spark: SparkSession):
    """Gives a function that writes a frame as parquet to the shared folder and reads it back.
    What it wrote is removed at the end, so it only serves work that ends within."""
    paths: list[str] = []

    def stage(df: DataFrame) -> DataFrame:
        paths.append(shared_path(spark, "stage"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            remove_path(spark, path)
