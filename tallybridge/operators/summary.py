"""Review rows and the counts of a run, by supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def source_only(offers: DataFrame, matches: DataFrame) -> DataFrame:
    return offers.join(matches.where("status = 'unmatched'").select("supplier", "supplier_item_id"), ["supplier", "supplier_item_id"], "left_semi")


def review_queue(offers: DataFrame, matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Offers a person must look at, beside the product they may be."""
    ours = offers.select("supplier", "supplier_item_id", *[F.col(c).alias(f"source_{c}") for c in ("name", "manufacturer", "mpn", "ean")], "source_price", "currency", F.col("available").alias("source_available"))
    theirs = catalog.select("supplier", F.col("product_id").alias("catalog_product_id"), *[F.col(c).alias(f"catalog_{c}") for c in ("sku", "name", "manufacturer", "model", "ean", "quantity", "status")], F.col("current_price").alias("catalog_price"))
    queue = matches.where(F.col("status").isin("conflict", "high_confidence", "ambiguous")).withColumnRenamed("catalog_sku", "generated_sku")
    return queue.join(ours, ["supplier", "supplier_item_id"]).join(theirs, ["supplier", "catalog_product_id"], "left")


def status_counts(rows: DataFrame, column: str = "status") -> DataFrame:
    """(supplier, counts): a map in order of status."""
    n = rows.groupBy("supplier", column).agg(F.count("*").alias("n"))
    return n.groupBy("supplier").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias("counts"))


def _exact(offers: DataFrame, matches: DataFrame, catalog: DataFrame) -> DataFrame:
    return (
        matches.where("status = 'exact'")
        .select("supplier", "supplier_item_id", F.col("catalog_product_id").alias("product_id"))
        .join(offers.select("supplier", "supplier_item_id", "source_price", "currency", "available"), ["supplier", "supplier_item_id"])
        .join(catalog.select("supplier", "product_id", "current_price", "quantity"), ["supplier", "product_id"])
    )


def price_compare(offers: DataFrame, matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Exact matches by how the source price stands to the shop price, before any markup."""
    return price_counts(_exact(offers, matches, catalog))


def price_counts(rows: DataFrame) -> DataFrame:
    """The same from the rows (supplier, source_price, currency, current_price) of exact matches."""
    rub, a, b = F.col("currency").isin("RUB", "RUR"), F.col("source_price"), F.col("current_price")
    return rows.groupBy("supplier").agg(F.count_if(rub & (a == b)).alias("equal"), F.count_if(rub & (a > b)).alias("source_higher"), F.count_if(rub & (a < b)).alias("source_lower"), F.count_if(~rub).alias("not_comparable"))


def availability_compare(offers: DataFrame, matches: DataFrame, catalog: DataFrame) -> DataFrame:
    rows = _exact(offers, matches, catalog)
    source, shop = F.coalesce("available", F.lit(False)), F.coalesce("quantity", F.lit(0)) > 0
    return rows.groupBy("supplier").agg(F.count_if(source & shop).alias("both_available"), F.count_if(source & ~shop).alias("source_only_available"), F.count_if(~source & shop).alias("catalog_only_available"), F.count_if(~source & ~shop).alias("both_unavailable"))


def identity_coverage(offers: DataFrame) -> DataFrame:
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    images = [F.count_if(F.size(F.coalesce("image_urls", F.array())) > 0).alias("with_image")] if "image_urls" in offers.columns else []
    return offers.groupBy("supplier").agg(F.count("*").alias("source_items"), *images, F.count_if(filled("ean")).alias("with_ean"), F.count_if(filled("mpn")).alias("with_mpn"), F.count_if(filled("manufacturer")).alias("with_manufacturer"))


def completeness(offers: DataFrame, catalog: DataFrame, missing: DataFrame) -> DataFrame:
    """Feed against catalogue scope, ratios as decimals; an empty catalogue is covered in full."""
    rows = (
        catalog.groupBy("supplier").agg(F.count("*").alias("scope"))
        .join(offers.groupBy("supplier").agg(F.count("*").alias("source_items")), "supplier", "full")
        .join(missing.groupBy("supplier").agg(F.count("*").alias("missing")), "supplier", "left")
        .na.fill(0, ["scope", "source_items", "missing"])
    )
    ratio = lambda n: F.when(F.col("scope") == 0, F.lit(1).cast("decimal(38,18)")).otherwise((n.cast("decimal(18,0)") / F.col("scope").cast("decimal(18,0)")).cast("decimal(38,18)"))
    whole = F.col("missing") == 0
    return rows.select("supplier", "source_items", "scope", "missing", ratio(F.col("source_items")).alias("source_ratio"), ratio(F.col("scope") - F.col("missing")).alias("covered_ratio"), F.when(whole, "complete").otherwise("incomplete").alias("feed_status"), F.when(whole, "all_catalog_scope_items_seen").otherwise("source_does_not_cover_catalog_scope").alias("reason"))


def run_summary(offers: DataFrame, matches: DataFrame, proposals: DataFrame, missing: DataFrame) -> DataFrame:
    """One row per supplier: the counts that head a run's report."""
    parts = [
        offers.groupBy("supplier").agg(F.count("*").alias("source_items"), F.count_if("available").alias("source_available")),
        matches.groupBy("supplier").agg(F.count_if(F.col("status") == "exact").alias("exact"), F.count_if(F.col("status") == "unmatched").alias("source_only"), F.count_if(F.col("status").isin("conflict", "high_confidence", "ambiguous")).alias("review")),
        proposals.groupBy("supplier").agg(F.count_if(F.col("status") == "ready_for_review").alias("ready")),
        missing.groupBy("supplier").agg(F.count("*").alias("missing")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "supplier", "left")
    return out.na.fill(0)


def report_lines(summary: DataFrame) -> DataFrame:
    """Markdown text of each supplier's run."""
    lines = [F.format_string(f"- {c}: %d", F.col(c).cast("long")) for c in summary.columns if c != "supplier"]
    return summary.select("supplier", F.concat_ws("\n", F.format_string("# Supplier %s", F.col("supplier").cast("string")), *lines).alias("report"))
