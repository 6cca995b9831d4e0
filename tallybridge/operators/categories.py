"""Category forest paths, and category mappings learned from exact matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.store import checkpointed


def paths(categories: DataFrame) -> DataFrame:
    """(id, path array root first, broken): walk of the parent pointers by doubled steps.

    Every round joins the walks with themselves, so a chain of k levels takes about log2(k) rounds.  A walk that has
    not ended after as many rounds as all ids would need leads into a cycle: it is broken (cycle) and has its own
    name as path.  A walk that ends at a parent that is not there is broken (unknown_parent).  Ids are unique; categories
    of other suppliers or snapshots need an id that tells them apart.
    """
    rows = categories.select("id", "name", F.col("parent_id").alias("parent"))
    known = rows.select(F.col("id").alias("__p"))
    first = rows.join(known, F.col("parent") == F.col("__p"), "left")
    # up: where the walk stands, null when it has ended; lost: it ended at a parent that is not there.
    walk = checkpointed(first.select("id", "name", F.col("__p").alias("up"), (F.col("parent").isNotNull() & F.col("__p").isNull()).alias("lost"), F.lit(False).alias("endless")))
    steps = walk.drop("name", "endless")
    for _ in range(walk.count().bit_length()):
        if steps.where("up is not null").isEmpty():
            break
        on = steps.select(F.col("id").alias("__at"), F.col("up").alias("__to"), F.col("lost").alias("__lost"))
        steps = checkpointed(steps.join(on, F.col("up") == F.col("__at"), "left").select("id", F.col("__to").alias("up"), (F.col("lost") | F.coalesce("__lost", F.lit(False))).alias("lost")))
    ended = steps.select(F.col("id").alias("__id"), F.col("up").isNotNull().alias("endless"), "lost")
    known = walk.drop("endless", "lost").join(ended, F.col("id") == F.col("__id"))
    # Names are gathered on the walks that end.
    named = checkpointed(known.select("id", F.array("name").alias("path"), F.when(~F.col("endless"), F.col("up")).alias("up"), "endless", "lost"))
    while not named.where("up is not null").isEmpty():
        on = named.select(F.col("id").alias("__at"), F.col("up").alias("__to"), F.col("path").alias("__path"))
        onward = named.join(on, F.col("up") == F.col("__at"), "left")
        named = checkpointed(onward.select("id", F.concat(F.coalesce("__path", F.array().cast("array<string>")), "path").alias("path"), F.col("__to").alias("up"), "endless", "lost"))
    return named.select("id", "path", F.when(F.col("endless"), "cycle").when(F.col("lost"), "unknown_parent").alias("broken"))


def path_rejects(walked: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """(id, rule) of the broken walks of ``paths``; with ``used`` (id), the categories that offers name, only of those: the
    dialects that look up a path when an offer needs it refuse nothing else."""
    broken = walked.where("broken is not null").select("id", F.when(F.col("broken") == "cycle", "category_cycle").otherwise("unknown_parent").alias("rule"))
    return broken if used is None else broken.join(used.select("id").distinct(), "id", "left_semi")


def mapping(offers: DataFrame, matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per (supplier, category_path): how exact matches map it to shop categories.

    The dominant target has most support, ties going to the one met first in feed order.
    """
    rows = offers.select("supplier", "supplier_item_id", "category_path", "feed_pos").join(matches.select("supplier", "supplier_item_id", "status", "catalog_product_id"), ["supplier", "supplier_item_id"])
    products = catalog.select("supplier", F.col("product_id").alias("catalog_product_id"), "category_ids", "categories", F.lit(True).alias("there"))
    return map_rows(rows.join(products, ["supplier", "catalog_product_id"], "left").withColumn("exact", (F.col("status") == "exact") & F.col("there")))


def map_rows(rows: DataFrame) -> DataFrame:
    """The same from rows (supplier, category_path, feed_pos, status, exact, category_ids, categories): a row of an exact match has the
    categories of its product."""
    key, exact = ["supplier", "category_path"], F.coalesce("exact", F.lit(False))
    target = [F.when(exact, F.coalesce(c, F.lit(""))).alias(c) for c in ("category_ids", "categories")]
    # An offer without a target counts for its category only; supports and totals come from one pass.
    each = rows.groupBy(*key, *target).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "unmatched").alias("new"), F.min("feed_pos").alias("first_pos"))
    has = F.col("category_ids").isNotNull()
    ranked = F.array_sort(F.collect_list(F.when(has, F.struct((-F.col("n")).alias("order"), "first_pos", "category_ids", "categories", F.col("n").alias("support")))))
    out = each.groupBy(*key).agg(F.sum("n").alias("source_total"), F.sum("new").alias("source_only_products"), F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias("exact_support"), ranked.alias("ranked"))
    out = out.withColumn("top", F.get("ranked", F.lit(0)))
    top = F.coalesce("top.support", F.lit(0))
    status = (
        F.when((F.col("exact_support") >= 3) & (top == F.col("exact_support")), "strong_candidate")
        .when((F.col("exact_support") >= 2) & (top * 10 >= F.col("exact_support") * 8), "review_candidate")
        .when(F.col("exact_support") > 0, "ambiguous")
        .otherwise("unmapped")
    )
    dominance = F.when(F.col("exact_support") > 0, top / F.col("exact_support")).otherwise(F.lit(0.0))
    return out.select(
        *key,
        "source_total",
        "source_only_products",
        "exact_support",
        F.coalesce("top.category_ids", F.lit("")).alias("suggested_category_ids"),
        F.coalesce("top.categories", F.lit("")).alias("suggested_categories"),
        top.alias("dominant_support"),
        dominance.alias("dominance"),
        F.bround(dominance * 100, 2).alias("dominance_pct"),
        F.transform(F.coalesce("ranked", F.array()), lambda t: F.struct(t["category_ids"].alias("category_ids"), t["categories"].alias("categories"), t["support"].alias("support"))).alias("alternatives"),
        status.alias("mapping_status"),
        F.lit(False).alias("publication_eligible"),
    )


def product_proposals(offers: DataFrame, matches: DataFrame, mapped: DataFrame) -> DataFrame:
    """Category proposals of the offers that match no product."""
    return propose_rows(offers.join(matches.where("status = 'unmatched'").select("supplier", "supplier_item_id"), ["supplier", "supplier_item_id"]), mapped)


def propose_rows(new: DataFrame, mapped: DataFrame) -> DataFrame:
    """The same from the offers that match no product."""
    rows = new.join(mapped.select("supplier", "category_path", "suggested_category_ids", "suggested_categories", "mapping_status"), ["supplier", "category_path"])
    proposal = F.when(F.col("mapping_status").isin("strong_candidate", "review_candidate"), "review_only").when(F.col("mapping_status") == "ambiguous", "blocked_ambiguous_category").otherwise("blocked_unmapped")
    return rows.select("supplier", "supplier_item_id", "catalog_sku", "name", "category_path", "suggested_category_ids", "suggested_categories", "mapping_status", proposal.alias("proposal_status"), F.lit(False).alias("publication_eligible"))


def summary(mapped: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row per supplier of counts by status."""
    n = lambda s: F.count_if(F.col("mapping_status") == s)
    left = mapped.groupBy("supplier").agg(F.count("*").alias("source_categories"), n("strong_candidate").alias("strong"), n("review_candidate").alias("review"), n("ambiguous").alias("ambiguous"), n("unmapped").alias("unmapped"))
    right = proposals.groupBy("supplier").agg(F.count("*").alias("source_only_products"), F.count_if(F.col("proposal_status") == "review_only").alias("source_only_with_candidate"))
    return left.join(right, "supplier", "left").na.fill(0).withColumn("publication_eligible", F.lit(0))
