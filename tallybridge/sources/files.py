"""Files as they land: those that fit into a split are read whole, the larger ones in pieces.

A scan of pieces costs some microseconds for each of them and names its file in each; a whole file is one row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are read whole, if a split of the session may be as large.
WHOLE_BYTES = 8 << 20


@dataclass(frozen=True)
class Files:
    """``whole``: (file, size, content) of the files that fit, with the columns of partitioned folders; the names of larger ones, and of those of no byte."""

    whole: DataFrame
    large: list[str] = field(default_factory=list)
    empty: list[str] = field(default_factory=list)


def whole_bytes(spark: SparkSession) -> int:
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return min(WHOLE_BYTES, split)


def read_whole(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """``Files.whole``; the length is known from the listing, so no content of a larger file is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    more = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    return files.where(F.col("length") <= whole_bytes(spark)).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"), "content", *more)


def list_files(spark: SparkSession, path: str | list[str], recursive: bool = True) -> Files:
    """The files under a path, or under each of a list.  Scans give no row for a file of no byte, so folders are walked for those; asked for
    a file's place or owner, Hadoop would start a process for each file of a local disk."""
    limit, large, empty = whole_bytes(spark), [], []
    left = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in ([path] if isinstance(path, str) else path)]
    while left:
        top = left.pop()
        for status in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top):
            if status.isDirectory():
                if not status.getPath().getName().startswith(("_", ".")):
                    left.append(status.getPath())
            elif not 0 < (size := status.getLen()) <= limit and not status.getPath().getName().startswith(("_", ".")):
                (large if size else empty).append(status.getPath().toString())
    return Files(read_whole(spark, path, recursive), large, empty)
