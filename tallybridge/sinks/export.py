"""Sinks: CSV safe for spreadsheets, JSON lines, and tables committed by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.canonical import canonical_cell
from tallybridge.functions.store import stored
from tallybridge.functions.text import csv_safe


def csv_cells(df: DataFrame, fields: list[str]) -> DataFrame:
    """Chosen fields as text cells: nested values as canonical JSON, formulas neutralised."""
    kinds = dict(df.dtypes)
    cell = lambda c: canonical_cell(df, c) if kinds[c].startswith(("array", "map", "struct")) else F.col(c).cast("string")
    return df.select(*[csv_safe(cell(c)).alias(c) for c in fields])


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    csv_cells(df, fields).write.option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.option("ignoreNullFields", False).json(path)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Rows of one run as a partition of its own; a run that is retried replaces its own rows.
    Readers join the manifest, whose row comes last, so half a run is never seen."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def write_manifest(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)


def read_committed(df: DataFrame, manifest: DataFrame) -> DataFrame:
    return df.join(manifest.select("run_id").distinct(), "run_id", "left_semi")


def with_positions(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows in order of ``keys`` and ``position``, their place from 1; ties in any order.

    Rows are dealt by ranges and sorted in place, so no task holds more than its range; how many
    rows each range has is all that meets in the driver.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    tagged = stored(parts.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")), "ordered")
    sizes = sorted((r[0], r[1], r[2]) for r in tagged.groupBy("__part").agg(F.count("*"), F.min("__at")).collect())
    shift, before = [], 0
    for part, size, first in sizes:
        shift.append((part, before - first + 1))
        before += size
    shifts = df.sparkSession.createDataFrame(shift, "__part int, __shift long")
    placed = tagged.join(F.broadcast(shifts), "__part").withColumn("position", F.col("__at") + F.col("__shift"))
    return placed.select("position", *df.columns)
