"""Identity match of supplier offers with catalogue products: SKU, then EAN, then brand and model.

One plan over all suppliers.  Offers and products are one table, and windows over (supplier, key) count on
both sides of each key (a row with a blank key carries one of its own, so it forms no hot key); one CASE
decides, and a window over the product that it names gives the turn and the product's facts.  Dealt by
supplier, as ``by_supplier`` does, all windows are sorted in place and the rows are shuffled once; otherwise each
window is dealt by its own key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybridge.functions.text import identity_key, non_blank, strip

def _brand_model(manufacturer: Column, model: Column) -> Column:
    # Both keys are made once; as plain expressions they would be made again for each use.
    keys = F.transform(F.array(F.struct(identity_key(manufacturer).alias("brand"), identity_key(model).alias("name"))), lambda k: F.when((k["brand"] != "") & (k["name"] != ""), F.concat_ws("|", k["brand"], k["name"])))
    return F.get(keys, F.lit(0))


def catalog_keys(catalog: DataFrame) -> dict[str, DataFrame]:
    """By sku, ean and brand_model: (supplier, key, hits, product_id), the smallest id of the hits."""
    keys = {"sku": F.col("sku"), "ean": non_blank(F.col("ean")), "brand_model": _brand_model(F.col("manufacturer"), F.col("model"))}
    # Null keys go after the count: a filter before it would make the key a second time.
    return {
        name: catalog.select("supplier", key.alias("key"), "product_id").groupBy("supplier", "key").agg(F.count("key").alias("hits"), F.min("product_id").alias("product_id")).where("hits > 0")
        for name, key in keys.items()
    }


def own_keys(offers: DataFrame) -> dict[str, DataFrame]:
    """By ean and brand_model: (supplier, key, own), how many offers of the supplier have the key."""
    keys = {"ean": non_blank(F.col("ean")), "brand_model": offer_brand_model()}
    return {name: offers.select("supplier", key.alias("key")).groupBy("supplier", "key").agg(F.count("key").alias("own")).where("own > 0") for name, key in keys.items()}


def offer_brand_model() -> Column:
    return _brand_model(F.col("manufacturer"), F.coalesce(F.nullif("mpn", F.lit("")), "model"))


#: Rows of one supplier, offers and products, up to which its rows may meet in one task; and rows that a task is to have in the mean.
SUPPLIER_ROWS, TASK_ROWS = 2_000_000, 200_000


def supplier_rows(offers: DataFrame, catalog: DataFrame) -> tuple[int, int]:
    """(most rows of one supplier, rows of all), offers and products."""
    both = offers.select("supplier").union(catalog.select("supplier"))
    return tuple(both.groupBy("supplier").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first())


def small_suppliers(offers: DataFrame, catalog: DataFrame) -> bool:
    """Whether every supplier has so few rows that ``match`` may deal them by supplier."""
    return supplier_rows(offers, catalog)[0] <= SUPPLIER_ROWS


def tasks_for(rows: int, spark: SparkSession) -> int:
    """Tasks among which so many rows are dealt by supplier: what a task sorts follows its rows, not their bytes in the shuffle."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def _filled(x: Column, key: Column) -> Column:
    """The key of a value; null where there is no value, blank where nothing of it is left."""
    return F.when(F.coalesce(x, F.lit("")) != "", key)


def match(offers: DataFrame, catalog: DataFrame, repeated_products: bool = False, by_supplier: bool = False, offer_columns: tuple[str, ...] = (), product_columns: tuple[str, ...] = (), dealt: bool = False) -> DataFrame:
    """(supplier, supplier_item_id, feed_pos, catalog_sku, catalog_product_id, status, confidence,
    matched_by, warnings) of every offer.

    offers needs identity_warnings (array); the first offer in feed_pos order claims a product, a
    later one with the same candidate is ambiguous.  Keys are compared inside one supplier.  Product
    ids (0 or more) and item ids are unique in a supplier, as the duplicate rules see to before; of a catalogue
    that repeats an id one row counts for the facts (``repeated_products`` says so to the reader, the plan is the same).

    ``by_supplier`` deals the rows by supplier, once (see ``small_suppliers``); tables that are ``dealt`` so already are not dealt
    again.  ``offer_columns`` of the offer come out
    as struct ``o``, ``product_columns`` of the product that it claims as struct ``p``.
    """
    text = lambda c: _filled(F.col(c), identity_key(F.col(c)))
    ean = _filled(F.col("ean"), strip(F.col("ean")))
    asked = F.struct("supplier_item_id", F.when(F.size("identity_warnings") > 0, F.col("identity_warnings")).alias("identity_warnings"), *offer_columns)
    ours = offers.select("supplier", "feed_pos", F.lit(None).cast("long").alias("product_id"), F.col("catalog_sku").alias("sku"), ean.alias("ean"), text("manufacturer").alias("brand"), text("mpn").alias("name"), text("model").alias("model"), asked.alias("o"))
    facts = F.struct(*product_columns) if product_columns else F.struct(F.lit(True).alias("there"))
    theirs = catalog.select("supplier", F.lit(None).cast(dict(offers.dtypes)["feed_pos"]).alias("feed_pos"), F.col("product_id").cast("long").alias("product_id"), "sku", ean.alias("ean"), text("manufacturer").alias("brand"), text("model").alias("name"), facts.alias("p"))
    rows = ours.unionByName(theirs, allowMissingColumns=True)
    if by_supplier and not dealt:
        rows = rows.repartition("supplier")
    # A key that no other row has: null keys would meet in one task.
    none = F.concat(F.lit("\u0000"), F.coalesce(F.concat(F.lit("o"), F.col("feed_pos").cast("string")), F.col("product_id").cast("string")))
    known_as = F.coalesce("name", "model")
    keys = {"s": F.col("sku"), "e": F.nullif("ean", F.lit("")), "b": F.when((F.col("brand") != "") & (known_as != ""), F.concat_ws("|", "brand", known_as))}
    for short, key in keys.items():
        # The hash comes first, so that the sort compares numbers; the key itself decides.
        same = Window.partitionBy("h", "supplier", "k")
        rows = rows.withColumn("k", F.coalesce(key, none)).withColumn("h", F.xxhash64("supplier", "k")).withColumns({f"{short}_hits": F.count("p").over(same), f"{short}_own": F.count("o").over(same), f"{short}_product": F.min("product_id").over(same)}).drop("h", "k")
    n = {c: F.col(f"{c}_hits") for c in "seb"}
    flagged = F.col("o.identity_warnings").isNotNull()
    way = (
        F.when(flagged, "identity_conflict")
        .when(n["s"] == 1, "sku")
        .when(n["s"] > 1, "catalog_sku_not_unique")
        .when((n["e"] == 1) & (F.col("e_own") == 1), "ean_unique")
        .when(n["e"] >= 1, "ean_not_unique")
        .when((n["b"] == 1) & (F.col("b_own") == 1), "manufacturer_model_unique")
        .when(n["b"] >= 1, "manufacturer_model_not_unique")
    )
    rows = rows.withColumn("way", F.when(F.col("o").isNotNull(), way))
    product = F.when(F.col("way") == "sku", F.col("s_product")).when(F.col("way") == "ean_unique", F.col("e_product")).when(F.col("way") == "manufacturer_model_unique", F.col("b_product"))
    # Offers without a candidate get a key of their own: the window has no hot null group.
    rows = rows.select("supplier", "feed_pos", "product_id", "sku", "ean", "brand", "name", "o", "p", "way", F.coalesce("product_id", product, -1 - F.col("feed_pos")).alias("pid"))
    # The product comes before its offers, in order of the feed.
    claim = Window.partitionBy("supplier", "pid").orderBy(F.col("feed_pos").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_product = F.when(F.col("p").isNotNull(), F.struct("ean", "brand", "name", "p"))
    rows = rows.withColumn("f", of_product).withColumns({"turn": F.count("o").over(claim), "f": F.first("f", ignorenulls=True).over(claim)}).where("o is not null")
    rows = rows.withColumn("pid", F.when(F.col("pid") >= 0, F.col("pid")))
    found = F.col("pid").isNotNull()
    reused, claimed = found & (F.col("turn") > 1), found & (F.col("turn") == 1)
    mismatches = F.array_compact(F.array(*[F.when(F.col(c) != F.col(f"f.{c}"), f"{what}_mismatch") for c, what in (("ean", "ean"), ("name", "model"), ("brand", "manufacturer"))]))
    rows = rows.withColumn("mismatches", F.when(claimed, mismatches))
    way = F.col("way")
    conflict = ((way == "sku") & (F.size("mismatches") > 0)) | ((way == "manufacturer_model_unique") & F.array_contains("mismatches", "ean_mismatch"))
    status = (
        F.when(way.isNull(), "unmatched")
        .when(~claimed, "ambiguous")
        .when(conflict, "conflict")
        .when(way == "sku", "exact")
        .otherwise("high_confidence")
    )
    confidence = F.when(claimed & conflict, 0.50).when(claimed & (way == "sku"), 1.00).when(claimed & (way == "ean_unique"), 0.95).when(claimed, 0.90).otherwise(0)
    matched_by = F.when(reused, "catalog_product_reused").when(way == "catalog_sku_not_unique", "sku").when(way.isin("ean_not_unique", "manufacturer_model_not_unique"), "identity_candidate").otherwise(way)
    warnings = (
        F.when(way.isNull(), F.array().cast("array<string>"))
        .when(flagged, F.array_distinct("o.identity_warnings"))
        .when(reused, F.array(F.lit("catalog_product_reused")))
        .when(claimed, F.col("mismatches"))
        .otherwise(F.array(way))
    )
    carried = [F.struct(*[f"o.{c}" for c in offer_columns]).alias("o")] if offer_columns else []
    carried += [F.when(claimed, F.col("f.p")).alias("p")] if product_columns else []
    return rows.select("supplier", F.col("o.supplier_item_id").alias("supplier_item_id"), "feed_pos", F.col("sku").alias("catalog_sku"), F.when(claimed, F.col("pid")).alias("catalog_product_id"), status.alias("status"), confidence.cast("decimal(3,2)").alias("confidence"), matched_by.alias("matched_by"), warnings.alias("warnings"), *carried)


def catalog_missing(catalog: DataFrame, matches: DataFrame) -> DataFrame:
    """(supplier, product_id, sku) of the products no offer has claimed."""
    claimed = matches.where("catalog_product_id is not null").select(F.col("supplier").alias("s"), F.col("catalog_product_id").alias("p"))
    return catalog.join(claimed, (F.col("supplier") == F.col("s")) & (F.col("product_id") == F.col("p")), "left_anti").select("supplier", "product_id", "sku")
