"""Missing-product state over a stream of runs: each micro-batch writes the products that its runs saw."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallybridge.operators.missing import stretches

STRETCHES = "supplier long, product_id long, first int, last int"


def read_stretches(spark: SparkSession, path: str) -> DataFrame:
    """The last stretch of each product over all micro-batches."""
    return stretches(spark.read.schema(STRETCHES).parquet(f"{path}/v=*"))


def run(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the stretches of each micro-batch of spans (see ``operators.missing.stretches``).

    A micro-batch may hold several runs, in any order.  What batch b writes depends on its rows only and goes to its own folder, so a
    batch that is retried gives the same again; stretches of one batch join on to those before when the state is read.
    """

    def apply(batch: DataFrame, number: int) -> None:
        stretches(batch).write.mode("overwrite").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe_landing(stream: DataFrame, within: str = "90 days") -> DataFrame:
    """Content of a supplier that lands again within a time of its first landing counts once; what is
    older leaves the state. The ledger, not the stream, knows content for ever."""
    return stream.withWatermark("landed_at", within).dropDuplicatesWithinWatermark(["supplier", "content_sha256"])
