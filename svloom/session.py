"""Cutting lineage, and keeping files, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; where none is set a temporary folder, but only if all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    return folder


def settled(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def kept(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """`df`, computed once and kept as Parquet in the shared folder; readers take the columns that they use."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
