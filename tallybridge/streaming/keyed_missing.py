"""Missing-product state kept by key in the state store: what a micro-batch writes follows its rows.

The stream has the missing products of complete runs only: (supplier, product_id, sku, run, place), place numbering the
complete runs of a supplier 1, 2 ...  A product that is not missing in a run has no row; its absence shows when it is next
missing, or when the state is read, by the places that lie between.  So a run touches the products it lacks and no others.
With a column ``first`` a row tells of adjoining runs at once: the product is missing at all places from first to place
(``absences``), so the rows follow the sightings and not products times runs.

The state store (RocksDB) holds the products in buckets, so that a call of Python serves many of them, and keeps its own
versions; how many buckets there are follows the products and is fixed for a checkpoint.  The rows that a micro-batch has
changed are appended to a table under the commit log, under the number of the micro-batch, so that one that is retried after a
restart counts once.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallybridge.functions.commits import CommitLog, State, fresh_part

_STATE = "sku string, streak int, last_place long, last_missing_run long, seen_place long"
CHANGED = f"supplier long, product_id long, {_STATE}"
CHANGED_NAMES = [c.split()[0] for c in CHANGED.split(", ")]
#: Buckets of products: a key of the state store holds those of a bucket that were ever missing, some PRODUCTS_A_BUCKET.
BUCKETS, PRODUCTS_A_BUCKET = 256, 4000
COMPRESSION = "zstd"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


_NUMBERS = ["supplier", "product_id", "streak", "last_place", "last_missing_run", "seen_place"]


def _packed(held: pd.DataFrame) -> bytes:
    """The rows of a bucket column by column, in order of their keys; the skus are left out where none is given."""
    skus = json.dumps(held["sku"].tolist()).encode() if held["sku"].notna().any() else b""
    numbers = np.array([held[c].to_numpy(np.int64) for c in _NUMBERS]).reshape(len(_NUMBERS), len(held))
    numbers[:2, 1:] = np.diff(numbers[:2])
    return zlib.compress(len(held).to_bytes(8, "big") + numbers.tobytes() + skus, 1)


def _unpacked(data: bytes) -> pd.DataFrame:
    data = zlib.decompress(data)
    n = int.from_bytes(data[:8], "big")
    end = 8 + 8 * n * len(_NUMBERS)
    numbers = np.frombuffer(data[8:end], np.int64).reshape(len(_NUMBERS), n).copy()
    numbers[:2] = np.cumsum(numbers[:2], axis=1)
    return pd.DataFrame(dict(zip(_NUMBERS, numbers, strict=True)) | {"sku": np.array(json.loads(data[end:]) if data[end:] else [None] * n, object)})


def count_missing(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts consecutive places at which the products of a bucket are missing; a place of 0 is none.  A row without ``first``
    has one place.  The rows that have changed come out.

    What is held of a product is the stretch that ends at its last place; the rows come after it in order of place.  Those that are told again
    are left out, the others join on to the stretch before or begin one, and the last one that begins counts.
    """
    told = [pdf.assign(first=pdf["first"] if "first" in pdf else pdf["place"]) for pdf in rows]
    new = pd.concat([pdf.drop(columns="sku") for pdf in told]).rename(columns={"place": "last_place", "run": "last_missing_run"}).assign(new=True, seen_place=0, streak=0)
    if state.exists:
        held = _unpacked(state.get[0])
        told.insert(0, held)
        new = pd.concat([held.drop(columns="sku").assign(new=False, first=held["last_place"] - held["streak"] + 1), new])
    skus = np.concatenate([pdf["sku"].to_numpy(object) for pdf in told])  # beside the rest: pandas looks at each null of a column it joins
    col = {c: new[c].to_numpy() for c in ("supplier", "product_id", "new", "last_place", "first")}
    order = np.lexsort([col[c] for c in ("first", "last_place", "new", "product_id", "supplier")])
    supplier, product, is_new, place, first = (c[order] for c in col.values())
    begins = lambda s, p: np.concatenate([[True], (s[1:] != s[:-1]) | (p[1:] != p[:-1])])[: len(s)]
    starts = begins(supplier, product)
    # The last place before each row: products are told apart by what is added to their places.
    apart = np.cumsum(starts) * (int(place.max(initial=0)) + 1)
    before = np.where(starts, 0, np.concatenate([[0], (np.maximum.accumulate(place + apart) - apart)[:-1]])[: len(place)])
    keep = ~is_new | (place > before)
    order, supplier, product, is_new, place, first, before = (c[keep] for c in (order, supplier, product, is_new, place, first, before))
    if not len(order):
        return
    starts = begins(supplier, product)
    first = np.where(is_new, np.maximum(first, before + 1), first)
    gap = (before > 0) & (first > before + 1)
    seen = np.where(gap, first - 1, new["seen_place"].to_numpy()[order])
    begun = np.maximum.accumulate(np.where(starts | gap, np.arange(len(order)), 0))
    ends = np.flatnonzero(np.concatenate([starts[1:], [True]]))
    now = new.iloc[order[ends]].assign(streak=(place - first[begun] + 1)[ends], seen_place=seen[begun][ends], sku=skus[order[ends]])
    state.update((_packed(now),))
    changed = now[is_new[ends]]
    if len(changed):
        yield changed[CHANGED_NAMES].astype({"streak": "int32"})


def absences(seen_at: DataFrame, runs: DataFrame, low: int, high: int) -> DataFrame:
    """(supplier, product_id, sku, run, place, first): the stretches of the places low to high at which products were missing, a
    row each; no sku is given (see ``run``); seen_at: supplier, product_id, at (the sorted places at which it was seen); runs: (run, place)."""
    inside = F.filter("at", lambda x: (x >= low) & (x <= high))
    # The edges are made once, for all that is asked of them.
    edges = seen_at.select("supplier", "product_id", F.concat(F.array(F.lit(low - 1)), inside, F.array(F.lit(high + 1))).alias("edges"))
    between = F.transform(F.slice("edges", F.lit(2), F.size("edges") - 1), lambda b, i: F.struct((F.get("edges", i) + 1).alias("first"), (b - 1).alias("place")))
    rows = edges.select("supplier", "product_id", F.inline(F.filter(between, lambda g: g["first"] <= g["place"])))
    named = rows.join(F.broadcast(runs.select("run", "place")), "place")  # as many rows as runs
    return named.select("supplier", "product_id", F.lit(None).cast("string").alias("sku"), "run", F.col("place").cast("long").alias("place"), F.col("first").cast("long").alias("first"))


def buckets_for(n_products: int) -> int:
    return max(16, -(-n_products // PRODUCTS_A_BUCKET))


def run(stream: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the state of the missing rows of ``stream``; the changed rows of each micro-batch go to the table at ``path``.
    ``buckets`` must stay the same for a checkpoint.  A row without a sku has the one that is made of supplier and product_id, which is
    neither shuffled nor kept (``current`` makes it)."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    log = CommitLog(spark, path)

    def commit(batch: DataFrame, number: int) -> None:
        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]]:
            folder = fresh_part()
            batch.write.option("compression", COMPRESSION).parquet(log.place(folder))
            return [(folder, {})], []

        log.update(f"micro-batch {number}", make, holds=lambda before, after: True)

    changed = stream.withColumn("bucket", F.pmod(F.xxhash64("supplier", "product_id"), F.lit(buckets))).groupBy("bucket").applyInPandasWithState(count_missing, CHANGED, "held binary", "update", GroupStateTimeout.NoTimeout)
    return changed.writeStream.foreachBatch(commit).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changes(spark: SparkSession, path: str) -> DataFrame:
    """Every changed row with the version that wrote it."""
    log = CommitLog(spark, path)
    parts = log.state().parts
    frames = [spark.read.schema(CHANGED).parquet(log.place(p.folder)).withColumn("version", F.lit(p.version)) for p in parts]
    return reduce(DataFrame.union, frames) if frames else spark.createDataFrame([], f"{CHANGED}, version int")


def current(changed: DataFrame, runs: DataFrame) -> DataFrame:
    """The state (see ``operators.missing.STATE``) as of the last of the complete runs (run, place)."""
    newest = Window.partitionBy("supplier", "product_id").orderBy(F.col("version").desc())
    rows = changed.withColumn("turn", F.row_number().over(newest)).where("turn = 1")
    last = runs.agg(F.max("place").alias("now"))
    rows = rows.join(F.broadcast(last))  # one row
    gone = F.col("last_place") == F.col("now")
    sku = F.coalesce("sku", F.concat_ws("-", "supplier", "product_id")).alias("sku")
    at = rows.select("supplier", "product_id", sku, F.when(gone, F.col("streak")).otherwise(0).alias("consecutive_missing_runs"), F.when(gone, F.col("seen_place")).otherwise(F.col("now")).alias("place"), "last_missing_run")
    seen = runs.select(F.col("run").alias("last_seen_run"), F.col("place").alias("p"))
    return at.join(F.broadcast(seen), F.col("place") == F.col("p"), "left").select("supplier", "product_id", "sku", "consecutive_missing_runs", "last_seen_run", "last_missing_run")  # as many rows as runs
