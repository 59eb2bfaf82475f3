"""Shared scratch tables: the reliable way to cut lineage or hand data on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the session names.

    A local session without one gets a temporary folder. A cluster session
    without one is an error: a machine-local folder would not be visible to
    the other executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="glotta-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back. The shuffle files of the write go with its end.

    Spark else keeps them until the driver happens to collect its garbage, so
    that the disk holds those of every table written before.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Survives the loss of any executor, and the file sizes give the optimizer
    real statistics for its own broadcast decisions.
    """
    return write_table(df, new_path(df.sparkSession, name))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
