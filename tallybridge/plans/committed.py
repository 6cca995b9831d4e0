"""Registered queries on tables under a commit log: the ledger over batches that overlap, and states that runs promote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions.store import fresh_folder
from tallybridge.plans.landing import _spark
from tallybridge.sinks.ledger import SnapshotLedger, StateTable
from tallybridge.streaming import landed_feeds

#: Content of a supplier lands again in other batches (an order's priority is its batch), some with another contract or without metadata.
LANDINGS_SQL = """
SELECT CAST(o_custkey AS BIGINT) AS supplier, concat('h', CAST(o_orderkey % 7 AS STRING)) AS content_sha256, CAST(o_orderdate AS STRING) AS feed_date,
  CASE WHEN o_orderkey % 50 = 3 THEN 'v2' ELSE 'v1' END AS contract, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('m', CAST(o_orderkey % 7 AS STRING)) END AS metadata,
  CAST(o_orderkey % 4 AS BIGINT) AS batch
FROM orders"""

LANDED_SQL = """
SELECT CAST(o_custkey AS BIGINT) AS supplier, concat('h', CAST(o_orderkey % 5 AS STRING)) AS content_sha256, CAST(o_orderdate AS STRING) AS feed_date, 'v1' AS contract,
  CAST(NULL AS STRING) AS metadata, CAST(o_orderdate AS TIMESTAMP) AS landed_at, CAST(year(o_orderdate) AS INT) AS year
FROM orders"""

STATES_SQL = """
SELECT DISTINCT l_suppkey AS supplier, l_partkey AS product_id, CAST(l_linenumber % 3 AS BIGINT) AS turn FROM lineitem"""

#: A supplier passes in run r unless (supplier + r) is a multiple of 4; in the last run, suppliers that are a multiple of 9 have no row.
RUNS = 3


def ledger_commits(spark, sf):
    """The ledger after four batches, one of them replayed, a writer that never committed, and a compaction in between."""
    ledger = SnapshotLedger(spark, fresh_folder(spark, "ledger"), snapshot_every=3)
    landings = _spark(spark, sf, LANDINGS_SQL, "orders")
    for n in (0, 1, 1, 2, 3):
        ledger.append(f"batch {n}", landings.where(F.col("batch") == n).drop("batch"))
        if n == 1:
            landings.drop("batch").write.mode("ignore").parquet(ledger.log.place("data-never-committed/rows"))
            ledger.compact()
    return ledger.rows().select("supplier", "content_sha256", "feed_date", "contract", "metadata")


def ledger_conflicts(spark, sf):
    """What the ledger of the first batch contradicts in the others."""
    ledger = SnapshotLedger(spark, fresh_folder(spark, "ledger"))
    landings = _spark(spark, sf, LANDINGS_SQL, "orders")
    ledger.append("batch 0", landings.where("batch = 0").drop("batch"))
    return ledger.conflicts(landings.where("batch <> 0").drop("batch"))


def landing_ledger(spark, sf):
    """Landings as a stream, a year in each micro-batch: content comes again within 90 days, and long after these."""
    folder = fresh_folder(spark, "landing-ledger")
    rows = _spark(spark, sf, LANDED_SQL, "orders")
    years = range(*rows.agg(F.min("year"), F.max("year") + 1).first())
    for year in years:
        rows.where(F.col("year") == year).drop("year").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.drop("year").schema).parquet(f"{folder}/in")
        ledger = SnapshotLedger(spark, f"{folder}/ledger")
        landed_feeds.land(stream, ledger, f"{folder}/checkpoint").awaitTermination()
    return ledger.rows().select("supplier", "content_sha256")


def state_promotions(spark, sf):
    """The current state after three runs, each of which replaces the suppliers that passed and no others."""
    table = StateTable(spark, fresh_folder(spark, "state"), "supplier long, product_id long, run long")
    rows = _spark(spark, sf, STATES_SQL, "lineitem")
    suppliers = rows.select("supplier").distinct()
    for run in range(RUNS):
        state = rows.where(F.col("turn") == run).select("supplier", "product_id", F.lit(run).cast("long").alias("run"))
        if run == RUNS - 1:
            state = state.where("supplier % 9 <> 0")
        batch = suppliers.select("supplier", F.when((F.col("supplier") + run) % 4 == 0, "FAIL").otherwise("PASS").alias("status"))
        table.promote(f"run {run}", state, batch)
    table.promote("run 0", rows.limit(0).select("supplier", "product_id", F.lit(9).cast("long").alias("run")), suppliers.select("supplier", F.lit("PASS").alias("status")))
    return table.rows().groupBy("supplier", "run").agg(F.count("*").alias("n"))


_ALL = [ledger_commits, ledger_conflicts, landing_ledger, state_promotions]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in _ALL}

#: Of each content the first batch that has it, in it the first row by date and contract; metadata that is lacking comes from the first batch with the same contract that has some.
_FIRST = f"""landings AS ({LANDINGS_SQL}), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY supplier, content_sha256 ORDER BY batch, feed_date, contract, metadata NULLS FIRST) AS turn FROM landings
), held AS (SELECT * FROM firsts WHERE turn = 1)"""

ORACLE: dict[str, str] = {
    "ledger_commits": f"""WITH {_FIRST}
SELECT h.supplier, h.content_sha256, h.feed_date, h.contract, coalesce(h.metadata, (SELECT arg_min(l.metadata, (l.batch, l.metadata)) FROM landings AS l
  WHERE l.supplier = h.supplier AND l.content_sha256 = h.content_sha256 AND l.contract = h.contract AND l.batch > h.batch AND l.metadata IS NOT NULL)) AS metadata FROM held AS h""",
    "ledger_conflicts": """WITH landings AS (%s), held AS (
  SELECT * FROM landings WHERE batch = 0 QUALIFY row_number() OVER (PARTITION BY supplier, content_sha256 ORDER BY feed_date, contract, metadata NULLS FIRST) = 1)
SELECT DISTINCT supplier, content_sha256, CASE WHEN l.contract <> h.contract THEN 'contract' ELSE 'metadata' END AS reason
FROM landings AS l JOIN held AS h USING (supplier, content_sha256) WHERE l.batch <> 0 AND (l.contract <> h.contract OR l.metadata <> h.metadata)""" % LANDINGS_SQL,
    "landing_ledger": "SELECT DISTINCT CAST(o_custkey AS BIGINT) AS supplier, concat('h', CAST(o_orderkey % 5 AS VARCHAR)) AS content_sha256 FROM orders",
    "state_promotions": f"""WITH state AS ({STATES_SQL}), suppliers AS (SELECT DISTINCT supplier FROM state),
last AS (SELECT supplier, max(r) AS run FROM suppliers, range({RUNS}) AS t(r) WHERE (supplier + r) % 4 <> 0 GROUP BY supplier)
SELECT supplier, run::BIGINT AS run, count(*) AS n FROM state JOIN last USING (supplier) WHERE turn = run AND NOT (run = {RUNS - 1} AND supplier % 9 = 0) GROUP BY ALL""",
}
