"""Helpers shared by the training-data operators: table reading, shared folder, columns."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tallybridge-")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A session on one machine (local tests) may have none and gets a temporary folder; on a cluster
    that is an error, for executors do not see each other's folders.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        found = _own_folder()
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete stored tables whose last reader is done."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes of one batch that goes to a Python worker; whole texts, but few at a time.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def bounded(docs: DataFrame) -> DataFrame:
    """docs, and a session whose batches to Python workers are small: workers and the JVM hold
    some copies of a batch each.  Smaller settings of the session are kept."""
    conf = docs.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = re.fullmatch(r"([0-9]+)[bB]?", conf.get(key))
        except Exception:  # a version of Spark without this setting
            continue
        if now is None or not 0 < int(now[1]) <= most:
            conf.set(key, str(most))
    return docs


def parts(spark: SparkSession, least: int = 12) -> int:
    """Number of shuffle partitions that the session asks for."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def buckets(spark: SparkSession, n_bytes: int, bucket_bytes: int = 24 << 20) -> int:
    """Buckets for so many packed bytes: as the session asks, and more where one would grow large."""
    return max(parts(spark), -(-int(n_bytes) // bucket_bytes))
