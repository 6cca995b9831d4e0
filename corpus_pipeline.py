"""Corpus cleaning pipeline: each stage reads what the one before it kept.

Quality classifier, exact Jaccard join, benchmark decontamination, secret redaction, BPE encoding.
``run`` cuts the lineage after each stage by writing what it kept to the shared folder.  No SQL
expresses the learned stages; ``tests/llm/test_pipeline.py`` holds each stage against its own input.

Null and empty texts are scored as empty texts and otherwise pass all stages.  Rows that repeat
(one doc_id and text) are a group of copies, of which one stays; so are the rows with a null doc_id
and one text, which count as larger than any doc_id.  An empty table gives an empty result.  Extra
columns of ``docs`` are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import bpe, decontaminate, ngram_join, quality, secrets
from tallybridge.llm.common import stored, table
from tallybridge.llm.registry import tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the whole labelled corpus."""
    net = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return quality.classify(docs, net, docs.columns).where("predicted = 1").select(*columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with nearly the same word n-grams, the one of smallest id.

    The contract of the stages on word shingles: five words and a similarity of 0.8.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    of_text = F.xxhash64(F.lit("no id"), "text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    keyed = docs.select(*columns, F.coalesce(F.col("doc_id").cast("long"), of_text).alias("__key"))
    groups = ngram_join.similar_components(keyed, "__key", ngram=5, percent=80).select(F.col("__key").alias("__id"), "component_id")
    gone = stored(groups.where("__id <> component_id").select("__id").distinct(), "pipeline-gone")
    again = stored(groups.groupBy("__id").count().where("count > 1").select("__id"), "pipeline-again")
    few = gone.count() <= ngram_join.BROADCAST_IDS
    kept = keyed.join(F.broadcast(gone) if few else gone.hint("merge"), F.col("__key") == F.col("__id"), "left_anti")
    if not again.isEmpty():
        one = kept.join(again, F.col("__key") == F.col("__id"), "left_semi").dropDuplicates(["__key", "text"])
        kept = kept.join(again, F.col("__key") == F.col("__id"), "left_anti").union(one)
    return kept.select(*columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; n_chars follows the new text."""
    cleaned = secrets.redact(docs, secrets.fit(spark))
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else cleaned


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of the documents that are left."""
    return bpe.encode_documents(docs, tokenizer("byte_bpe_50k.json"), decoded=False)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_benchmark),
    ("secret scan", redact_secrets),
    ("BPE encoding", encode),
]

#: The classifier and the forest are learned: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
