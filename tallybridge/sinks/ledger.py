"""Tables under a commit log: the ledger of snapshots, and the state that runs promote."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallybridge.functions.commits import CommitLog, Part, State, fresh_part
from tallybridge.operators import audit


def _union(spark: SparkSession, schema: StructType | str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).parquet(p) for p in paths])


class SnapshotLedger:
    """Accepted content by (supplier, content_sha256), once each and for ever.

    landed rows have supplier, content_sha256, feed_date, metadata and the columns of ``contract``.  Content that is there
    with the same contract changes nothing, but for metadata that the ledger lacks, which is repaired; content with
    another contract, or with other metadata, is a conflict and changes nothing.  Of rows of one content in one
    batch the first by date and contract counts.  A null supplier or hash is no content and is left out.
    """

    KEY = ["supplier", "content_sha256"]

    def __init__(self, spark: SparkSession, path: str, contract: str = "contract string", snapshot_every: int = 16):
        self.spark, self.log = spark, CommitLog(spark, path, snapshot_every)
        self.schema = f"supplier long, content_sha256 string, feed_date string, {contract}, metadata string"
        self.contract = spark.createDataFrame([], contract).columns

    def _tables(self, state: State, name: str, schema: str) -> DataFrame:
        return _union(self.spark, schema, [self.log.place(f"{p.folder}/{name}") for p in state.parts if name in p.note["tables"]])

    def rows(self, state: State | None = None) -> DataFrame:
        state = state or self.log.state()
        repaired = self._tables(state, "repairs", "supplier long, content_sha256 string, metadata string").groupBy(*self.KEY).agg(F.min("metadata").alias("__repaired"))
        return self._tables(state, "rows", self.schema).join(repaired, self.KEY, "left").withColumn("metadata", F.coalesce("metadata", "__repaired")).drop("__repaired")

    def append(self, batch: str, landed: DataFrame) -> bool:
        """Commit a batch; False if it was there before.  Whatever others commit meanwhile is read before it counts."""

        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]]:
            folder = fresh_part()
            given = landed.select(*[c.split()[0] for c in self.schema.split(", ")]).where("supplier is not null and content_sha256 is not null")
            there = self.rows(state)
            new, _ = audit.ledger_append(there, given, self.contract)
            new.write.parquet(self.log.place(f"{folder}/rows"))
            pairs = self._pairs(given, there)
            pairs.where(~self._differs() & F.col("o.metadata").isNull() & F.col("n.metadata").isNotNull()).groupBy("supplier", "content_sha256").agg(F.min("n.metadata").alias("metadata")).write.parquet(self.log.place(f"{folder}/repairs"))
            return [(folder, {"tables": ["rows", "repairs"]})], []

        return self.log.update(batch, make)

    def _pairs(self, given: DataFrame, there: DataFrame) -> DataFrame:
        return given.alias("n").join(there.alias("o"), self.KEY)

    def _differs(self):
        return reduce(lambda x, c: x | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")), self.contract, F.lit(False))

    def conflicts(self, landed: DataFrame) -> DataFrame:
        """(supplier, content_sha256, reason) of rows that the ledger contradicts."""
        other = (F.col("n.metadata") != F.col("o.metadata")) & F.col("n.metadata").isNotNull()
        reason = F.when(self._differs(), "contract").when(other, "metadata")
        return self._pairs(landed, self.rows()).select(*self.KEY, reason.alias("reason")).where("reason is not null").distinct()

    def compact(self) -> bool:
        """One folder for all; given up if another writer has replaced one of them meanwhile."""

        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]] | None:
            if len(state.parts) < 2:
                return None
            folder = fresh_part()
            self.rows(state).write.parquet(self.log.place(f"{folder}/rows"))
            return [(folder, {"tables": ["rows"]})], [p.folder for p in state.parts]

        return self.log.update(None, make, kind="compact")


class StateTable:
    """The current state of each supplier, replaced as a whole by the runs that promote it.

    A promotion writes the rows of its suppliers aside and commits them with the list of these suppliers; of each
    supplier the last version that names it counts, so a supplier whose run did not pass keeps what it had, and one
    that is promoted without a row has none.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.schema, self.log = spark, schema, CommitLog(spark, path)

    def promote(self, run: str, state: DataFrame, batch: DataFrame) -> bool:
        """Of a run, the suppliers whose status (supplier, status) is PASS; False if the run was promoted before."""

        def make(now: State) -> tuple[list[tuple[str, dict]], list[str]]:
            folder = fresh_part()
            audit.promote_state(state, batch).write.parquet(self.log.place(f"{folder}/rows"))
            batch.where("status = 'PASS'").select(F.col("supplier").cast("long").alias("supplier")).distinct().write.parquet(self.log.place(f"{folder}/suppliers"))
            return [(folder, {})], []

        # It does not read the table, so what was written holds whatever came between.
        return self.log.update(run, make, holds=lambda before, after: True)

    def _versions(self, parts: tuple[Part, ...]) -> DataFrame:
        frames = [self.spark.read.schema("supplier long").parquet(self.log.place(f"{p.folder}/suppliers")).withColumn("__version", F.lit(p.version)) for p in parts]
        every = reduce(DataFrame.union, frames)
        return every.groupBy("supplier").agg(F.max("__version").alias("__version"))

    def rows(self) -> DataFrame:
        parts = self.log.state().parts
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        frames = [self.spark.read.schema(self.schema).parquet(self.log.place(f"{p.folder}/rows")).withColumn("__version", F.lit(p.version)) for p in parts]
        return reduce(DataFrame.union, frames).join(self._versions(parts), ["supplier", "__version"], "left_semi").drop("__version")

