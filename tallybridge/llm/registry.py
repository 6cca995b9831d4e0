"""Queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm import bpe, dac, decontaminate, embeddings, html_text, mining, ngram_join, pii, quality, secrets, spelling, substrings, token_counts
from tallybridge.llm.common import fresh_path, stored, table
from tallybridge.llm.oracle import ORACLE


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file."""
    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.classify(docs, net, ["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.tokenise(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(spark))


def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("copy", F.sha2(F.coalesce("text", F.lit("")), 256))
    counted = stored(dac.count_documents(docs, tokenizer("word_bpe_49k.json"), ["doc_id", "source", "lang", "copy"]), "token-counts")
    return token_counts.maintained_totals(spark, counted, fresh_path(spark, "token-rollup"), "word_bpe_49k")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"), pii.fit(spark))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return mining.hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 50 == 0, label_col=moved)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


__all__ = ["ORACLE", "QUERIES", "tokenizer"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_files": op5_token_files,
    "op6_secrets": op6_secrets,
    "op7_embeddings": op7_embeddings,
    "op8_substrings": op8_substrings,
    "op9_bpe_codec": op9_bpe_codec,
    "op10_token_counts": op10_token_counts,
    "op11_personal_data": op11_personal_data,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}
