"""Feeds that land as files, as a stream: gates and row rules in each micro-batch, what they reject and what is accepted committed together.

A micro-batch has whole files, of MAX_BYTES together or one that is larger.  The structure of each is counted, its rows are read and checked, and a
supplier that a rule rejects gives rejects and no rows; the others of the micro-batch go on.  Both tables are committed under the
number of the micro-batch, so one that is replayed changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallybridge.functions.commits import CommitLog, State, fresh_part
from tallybridge.functions.store import stored
from tallybridge.sinks.ledger import SnapshotLedger
from tallybridge.sources.files import Files, read_whole, whole_bytes
from tallybridge.streaming.missing_stream import dedupe_landing

#: What a micro-batch reads at most: its fixed cost is paid for so many bytes, however many files they are.
MAX_BYTES = 2 << 30
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def feed_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The files that land below a folder, as a stream of their names (path, length), no content; with ``max_files``, at most so many
    in a micro-batch instead of MAX_BYTES."""
    limit = ("maxBytesPerTrigger", MAX_BYTES) if max_files is None else ("maxFilesPerTrigger", max_files)
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option(*limit).option("recursiveFileLookup", "true").load(folder).select("path", "length")


def run(stream: DataFrame, judge: Callable[[SparkSession, Files], tuple[DataFrame, DataFrame]], path: str, checkpoint: str) -> StreamingQuery:
    """judge (session, files of a micro-batch) gives (rows, rejects), both with a supplier; rows of rejected suppliers are left out."""
    log = CommitLog(stream.sparkSession, path)

    def commit(batch: DataFrame, number: int) -> None:
        landed = {r["path"]: r["length"] for r in batch.collect()}  # names of a micro-batch's files

        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]] | None:
            if not landed:
                return None
            folder, session = fresh_part(), batch.sparkSession
            most = whole_bytes(session)
            rows, rejects = judge(session, Files(read_whole(session, list(landed)), [f for f, n in landed.items() if n > most]))
            rejects = stored(rejects, "landed-rejects")
            rejects.write.parquet(log.place(f"{folder}/rejects"))
            rows.join(rejects.select("supplier").distinct(), "supplier", "left_anti").write.parquet(log.place(f"{folder}/rows"))
            return [(folder, {})], []

        log.update(f"micro-batch {number}", make, holds=lambda before, after: True)

    # Each file of a micro-batch is listed as a folder of its own, and a job has as many tasks for that, up to 10,000.
    spark = stream.sparkSession
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), max(32, 4 * spark.sparkContext.defaultParallelism))))
    try:
        return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(_LISTING, before)


def land(stream: DataFrame, ledger: SnapshotLedger, checkpoint: str, within: str = "90 days") -> StreamingQuery:
    """Landings (supplier, content_sha256, feed_date, the ledger's contract, metadata, landed_at) into the ledger.

    Content that lands again within a time is dropped by the stream, whose state leaves it out after that; content that
    lands again later is found in the ledger.  landed_at is the time of landing, so no row is later than the watermark allows.
    """

    def commit(batch: DataFrame, number: int) -> None:
        ledger.append(f"micro-batch {number}", batch.drop("landed_at"))

    return dedupe_landing(stream, within).writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """rows or rejects that are committed."""
    log = CommitLog(spark, path)
    return reduce(DataFrame.unionByName, [spark.read.parquet(log.place(f"{p.folder}/{name}")) for p in log.state().parts])
