"""Tables written to the folder that driver and executors share, and checkpoints there."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tallybridge-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only a session on one machine may do without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        found = _own_folder()
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """The table, written once and read back."""
    path = fresh_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()
