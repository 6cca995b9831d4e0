"""Adapters as data: which dialect reads a supplier's feed, looked up fail-closed.

The registry is a table (supplier, adapter, prefix, root).  A landing whose adapter is unknown, or whose prefix or root is not the
dialect's, gives a reject and none of its rows; the other landings are read, one scan for each dialect however many suppliers it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.operators import gates
from tallybridge.sources import feeds

#: Columns that every dialect gives.
COMMON = ["supplier_item_id", "catalog_sku", "name", "manufacturer", "mpn", "ean", "identity_warnings", "source_price", "quantity", "available", "currencyId", "categoryId", "image_urls", "conflicts", "refused"]


def rejects(registry: DataFrame) -> DataFrame:
    """(supplier, rule, row_key) of the registry's rows that no dialect serves."""
    prefixes = F.create_map(*[F.lit(x) for k, m in feeds.DIALECTS.items() for x in (k, m.sku_prefix)])
    roots = F.create_map(*[F.lit(x) for k in feeds.DIALECTS for x in (k, gates.ROOTS[k])])
    adapter = F.col("adapter")
    known = F.coalesce(adapter.isin(*feeds.DIALECTS), F.lit(False))
    rules = [
        F.when(~known, "unknown_adapter"),
        F.when(known & ~F.coalesce(F.col("prefix") == prefixes[adapter], F.lit(False)), "adapter_prefix"),
        F.when(known & ~F.coalesce(F.col("root") == roots[adapter], F.lit(False)), "adapter_root"),
    ]
    twice = registry.groupBy("supplier").count().where("count > 1").select("supplier", F.lit("adapter_twice").alias("rule"), F.lit(None).cast("string").alias("row_key"))
    return registry.select("supplier", F.explode(F.array_compact(F.array(*rules))).alias("rule"), adapter.cast("string").alias("row_key")).union(twice)


def _raw(spark: SparkSession, folder: str, mapping: feeds.Mapping) -> DataFrame:
    """Raw offers of ``folder``/supplier=<id>/; none where there is no such folder."""
    schema = f"{feeds.offer_schema(mapping)}, supplier long"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.format("xml").option("rowTag", "offer").schema(schema).load(folder)


def read(spark: SparkSession, registry: DataFrame, folder: str, by_adapter: bool = False) -> tuple[DataFrame, DataFrame]:
    """(offers with supplier and adapter, rejects): the feeds of ``folder``/supplier=<id>/ by the dialects that the registry names.

    ``by_adapter``: they lie in ``folder``/adapter=<adapter>/supplier=<id>/, so each folder is listed for one dialect and not for
    all; what lies under another adapter than the registry's is not read.
    """
    bad = rejects(registry)
    served = registry.join(bad.select("supplier").distinct(), "supplier", "left_anti").select("supplier", "adapter")
    parts = []
    for adapter, mapping in feeds.DIALECTS.items():
        raw = _raw(spark, f"{folder}/adapter={adapter}" if by_adapter else folder, mapping)
        mine = raw.join(served.where(F.col("adapter") == adapter), "supplier")
        parts.append(feeds.normalise(mine, mapping, ("supplier", "adapter")).select("supplier", "adapter", *COMMON))
    return reduce(DataFrame.unionByName, parts), bad
