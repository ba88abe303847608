"""Lineage cuts through the folder that all executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder where it is unset and the master local; else an error, for no local folder is shared."""
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not d:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), "skeinworks-shared")
    if not context.getCheckpointDir():
        context.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """The rows, written below the shared folder.

    A checkpoint hands on the constraints of its plan, and a loop of joins multiplies them until no plan is ready in
    time; so they are left out here.
    """
    spark, name = df.sparkSession, "spark.sql.constraintPropagation.enabled"
    shared_dir(spark)
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(name, was)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
