"""Rules that reject rows, and the snapshots those rows block, without stopping the others.

Every rule gives (supplier, rule, row_key); a supplier with any reject is blocked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.text import strict_decimal, strip


def _rows(df: DataFrame, rule: str, key: Column) -> DataFrame:
    return df.select("supplier", F.lit(rule).alias("rule"), key.cast("string").alias("row_key"))


def duplicates(df: DataFrame, rule: str, key: str) -> DataFrame:
    return _rows(df.groupBy("supplier", key).count().where("count > 1"), rule, F.col(key))


def unknown(df: DataFrame, key: str, known: DataFrame, known_key: str, rule: str, by: list[str] | None = None) -> DataFrame:
    """Rows whose key is set but not among the known ones (of the same supplier with ``by``)."""
    by = by or []
    there = known.select(*[F.col(c).alias(f"__{c}") for c in by], F.col(known_key).alias("__key")).distinct()
    on = reduce(lambda a, c: a & (F.col(c) == F.col(f"__{c}")), by, F.col(key) == F.col("__key"))
    return _rows(df.where(F.col(key).isNotNull()).join(there, on, "left_anti"), rule, F.col(key))


def required(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """A reject for each blank required field of each row."""
    blank = F.array_compact(F.array(*[F.when(F.coalesce(strip(F.col(c).cast("string")), F.lit("")) == "", F.lit(f"missing_{c}")) for c in columns]))
    return df.select("supplier", F.explode(blank).alias("rule"), F.col(key).cast("string").alias("row_key"))


def catalog_rows(df: DataFrame) -> DataFrame:
    """Rules of raw catalogue text rows (all columns strings)."""
    integer = lambda c: F.when(strip(F.col(c)).rlike("^-?[0-9]+$"), strip(F.col(c)).try_cast("long"))
    price = F.when(F.coalesce(strip(F.col("price")), F.lit("")) == "", F.lit(0).cast("decimal(20,4)")).otherwise(strict_decimal(F.col("price")))
    ok = lambda c: F.coalesce(c, F.lit(False))
    rules = [
        ("product_id", ~ok(integer("product_id") > 0)),
        ("sku", F.coalesce(strip(F.col("sku")), F.lit("")) == ""),
        ("price", ~ok(price >= 0)),
        ("quantity", ~ok(integer("quantity") >= 0)),
        ("status", integer("status").isNull()),
    ]
    failed = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return df.select("supplier", F.explode(failed).alias("rule"), F.col("product_id").alias("row_key"))


def blocked(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("supplier").agg(F.count("*").alias("n_rejects"), F.array_sort(F.collect_set("rule")).alias("rules"))


def accepted(df: DataFrame, rejects: DataFrame) -> DataFrame:
    return df.join(rejects.select("supplier").distinct(), "supplier", "left_anti")


def batch_status(suppliers: DataFrame, rejects: DataFrame, checks: DataFrame) -> DataFrame:
    """(supplier, status): BLOCKED by a reject, else FAIL by a check, else PASS."""
    failed = checks.groupBy("supplier").agg(F.bool_and("passed").alias("passed"))
    rows = suppliers.select("supplier").distinct().join(blocked(rejects).select("supplier", "n_rejects"), "supplier", "left").join(failed, "supplier", "left")
    return rows.select("supplier", F.when(F.col("n_rejects") > 0, "BLOCKED").when(~F.coalesce("passed", F.lit(True)), "FAIL").otherwise("PASS").alias("status"))


def exit_status(batch: DataFrame) -> DataFrame:
    """Counts of a batch, and its exit code: 2 for any FAIL, 1 for any BLOCKED, else 0."""
    n = {s: F.count_if(F.col("status") == s) for s in ("PASS", "BLOCKED", "FAIL")}
    return batch.agg(n["PASS"].alias("passed"), n["BLOCKED"].alias("blocked"), n["FAIL"].alias("failed"), F.max(F.when(F.col("status") == "FAIL", 2).when(F.col("status") == "BLOCKED", 1).otherwise(0)).alias("exit_code"))
