"""Delta-maintained token counts (operator 10).

The store is a folder of Parquet tables.  A batch of changes is turned into signed rows - an insert
adds, a delete takes away what the ledger holds, a revision does both - which are summed before they
are written: ``deltas`` holds additive totals (source, lang, tokenizer -> documents, tokens), ``ledger``
the signed count of every document the batch touched, in buckets of the document id.  Totals are the
sum of the deltas; a batch looks up its own documents in their buckets only, so its cost follows the
batch and not the history.  After COMPACT_AFTER batches the tables are summed into one.

Batches and compactions are versions of a commit log (``functions.commits``): a folder counts once a version names it,
a version is published whole or not at all, and a batch that is already there changes nothing.  Another writer's
batch that came in between may have touched the same documents, so the batch is then worked out anew; a compaction changes no
sum and lets it stand.  A compaction whose folders another one has replaced is worked out anew as well.  What a
broken run left without a version is never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions.commits import CommitLog, Part, State, fresh_part
from tallybridge.llm.common import discard, stored

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens"]
#: Documents of a batch that a bucket of its ledger is to hold, and the fewest buckets.
BUCKET_DOCS, LEAST_BUCKETS = 500_000, 8
COMPACT_AFTER = 32
#: A group of copies of more than one row in so many (and of 64) is joined by a broadcast: at most so many.
LARGE_GROUP = 10_000
_LEDGER = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, bucket int"
_DELTAS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")


class Rollup:
    """Token totals in the folder ``path`` of a store that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, n_buckets: int | None = None, compact_after: int = COMPACT_AFTER, snapshot_every: int = 16):
        self.spark, self.n_buckets, self.compact_after = spark, n_buckets, compact_after
        self.log = CommitLog(spark, path, snapshot_every)

    def folders(self) -> list[str]:
        """Folders that count."""
        return [p.folder for p in self.log.state().parts]

    def _table(self, name: str, schema: str, parts: tuple[Part, ...]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.union, [self.spark.read.schema(schema).parquet(self.log.place(f"{p.folder}/{name}")) for p in parts])

    def held(self, rows: DataFrame, state: State) -> DataFrame:
        """(doc_id, source, lang, tokenizer, n_docs, n_tokens): what the ledger holds of the documents
        and tokenizers in ``rows``; only their buckets are read."""
        asked = rows.where("doc_id is not null").select("doc_id", F.col("tokenizer").alias("t")).distinct()
        found = []
        for n in sorted({p.note["buckets"] for p in state.parts}):
            some = [r[0] for r in asked.select(_bucket(n)).distinct().collect()]  # at most n
            found.append(self._table("ledger", _LEDGER, tuple(p for p in state.parts if p.note["buckets"] == n)).where(F.col("bucket").isin(some)))
        ledger = reduce(DataFrame.union, found)
        asked = asked.withColumnRenamed("doc_id", "d")
        mine = ledger.join(asked, (ledger["doc_id"] == asked["d"]) & ledger["tokenizer"].eqNullSafe(asked["t"]), "left_semi")
        return mine.groupBy("doc_id", *KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over the committed batches; groups of no
        document are left out."""
        return self._table("deltas", _DELTAS, self.log.state().parts).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("n_docs <> 0 or n_tokens <> 0")

    def _write(self, folder: str, signed: DataFrame) -> None:
        signed.repartition("bucket").write.partitionBy("bucket").parquet(self.log.place(f"{folder}/ledger"))
        signed.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).write.parquet(self.log.place(f"{folder}/deltas"))

    def _written(self, signed: DataFrame) -> tuple[str, dict]:
        """The signed rows in a folder of their own, in buckets that follow their number."""
        rows = stored(signed, "token-signed")
        n = self.n_buckets
        if n is None:
            n, wanted = LEAST_BUCKETS, rows.count() / BUCKET_DOCS
            while n < wanted:
                n *= 2
        folder = fresh_part()
        self._write(folder, rows.withColumn("bucket", _bucket(n)))
        discard(rows)
        return folder, {"buckets": n}

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of (change, doc_id, source, lang, tokenizer, n_tokens); False if it was
        there before.

        change is insert, delete or revise; others, and null, change nothing.  Each takes away what
        the ledger holds of that document and tokenizer (nothing if it holds none), whatever source
        and lang the row gives; an insert and a revision then add their own row.  So a document
        that is inserted again counts once, by its last insert.  Rows of a document that repeat
        within a batch count once; rows of one document that differ are added each.  A null doc_id
        is a document of its own on every row, which cannot be found again: it can be inserted,
        not deleted or revised, and the ledger keeps the sums of such rows.  Null keys are groups of their own; a null n_tokens adds 0; other
        columns are ignored; an empty batch is committed without effect; a batch may have any name.

        A writer that is lost before its version is published leaves the batch to be committed by the next; of
        several writers of one batch one counts; batches of several writers count in the order of their versions.
        """
        rows = changes.where("change in ('insert', 'delete', 'revise')").select("change", F.col("doc_id").cast("long").alias("doc_id"), *[F.col(k).cast("string").alias(k) for k in KEYS], F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("n_tokens"))
        known = rows.where("doc_id is not null").distinct()
        added = known.where("change <> 'delete'").drop("change").distinct().select("doc_id", *KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")
        nameless = rows.where("doc_id is null and change = 'insert'").groupBy(*KEYS).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        signed = added.union(nameless.select(F.lit(None).cast("long").alias("doc_id"), *KEYS, *SUMS))

        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]]:
            if not state.parts:
                return [self._written(signed)], []
            return [self._written(signed.union(self.held(known, state).select("doc_id", *KEYS, -F.col("n_docs"), -F.col("n_tokens"))))], []

        def holds(before: State, after: State) -> bool:
            kinds = after.since(before.version)
            return kinds is not None and all(kind == "compact" for kind in kinds)

        done = self.log.update(batch, make, holds)
        if done and len(self.folders()) > self.compact_after:
            self.compact()
        return done

    def compact(self) -> bool:
        """Sum the folders that count into one; batches stay known by name.  False if there is nothing to sum."""

        def make(state: State) -> tuple[list[tuple[str, dict]], list[str]] | None:
            if len(state.parts) < 2:
                return None
            every = self._table("ledger", _LEDGER, state.parts).groupBy("doc_id", *KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where("n_docs <> 0 or n_tokens <> 0")
            return [self._written(every)], [p.folder for p in state.parts]

        def holds(before: State, after: State) -> bool:
            return {p.folder for p in before.parts} <= {p.folder for p in after.parts}

        return self.log.update(None, make, holds, kind="compact")


def marked_copies(counted: DataFrame) -> DataFrame:
    """counted and ``is_copy``: has another row of its text a smaller doc_id?  Null ids: null.

    Groups of a large share of the rows are few and are broadcast, so that none makes a hot key.
    """
    groups = counted.where("doc_id is not null").groupBy("copy").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    bound = max(64, counted.count() // LARGE_GROUP)
    large = groups.where(F.col("n") > bound).select(F.col("copy").alias("__copy"), F.col("first").alias("of_large"))
    small = groups.where((F.col("n") > 1) & (F.col("n") <= bound)).select("copy", "first")
    rows = counted.join(F.broadcast(large), F.col("copy").eqNullSafe(F.col("__copy")), "left").drop("__copy")
    rest = rows.where("of_large is null").join(small, "copy", "left").withColumn("first", F.coalesce("first", "doc_id"))
    every = rest.drop("of_large").unionByName(rows.where("of_large is not null").withColumnRenamed("of_large", "first"))
    return every.withColumn("is_copy", F.col("doc_id") > F.col("first")).drop("first")


def maintained_totals(spark: SparkSession, counted: DataFrame, path: str, tokenizer: str) -> DataFrame:
    """Totals after five commits over a corpus: every document inserted; exact copies (but the
    smallest id of a text) deleted; what is left in English moved to the next tokenizer version,
    which closes each document with one id more; the others' counts revised for such an id; and
    the second batch replayed, which changes nothing.

    counted: (doc_id, source, lang, copy, n_tokens), copy telling equal texts.  A null lang is one of
    the others.  A document with a null id is inserted and, as it cannot be found again, not changed
    after that.
    """
    rollup = Rollup(spark, path)
    rows = stored(marked_copies(counted).withColumn("tokenizer", F.lit(tokenizer)), "token-copies")
    copies = rows.where("is_copy").withColumn("change", F.lit("delete"))
    rollup.apply("1-insert", rows.withColumn("change", F.lit("insert")))
    rollup.apply("2-copies", copies)
    left = rows.where("not is_copy")
    english = F.col("lang").eqNullSafe("en")
    rollup.apply("3-retire", left.where(english).withColumn("change", F.lit("delete")))
    rollup.apply("4-closing-id", left.where(english).withColumn("change", F.lit("insert")).withColumn("tokenizer", F.lit(f"{tokenizer}+end")).withColumn("n_tokens", F.col("n_tokens") + 1))
    rollup.apply("5-recount", left.where(~english).withColumn("change", F.lit("revise")).withColumn("n_tokens", F.col("n_tokens") + 1))
    rollup.apply("2-copies", copies)
    discard(rows)
    return rollup.totals()
