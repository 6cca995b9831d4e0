"""Price proposals under an explicit policy; first failing rule names the status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reasons in the order they are tried: status, warning.
BLOCKS = [
    ("blocked_match", "match_not_exact"),
    ("blocked_source_price", "nonpositive_source_price"),
    ("blocked_currency", "currency_not_approved"),
    ("blocked_currency", "missing_or_invalid_exchange_rate"),
    ("blocked_currency", "currency_parity_not_approved"),
    ("blocked_vat_basis", "vat_basis_unknown"),
    ("blocked_missing_markup", "markup_policy_not_approved"),
    ("blocked_markup", "invalid_markup_rule"),
]


def propose(offers: DataFrame, matches: DataFrame, catalog: DataFrame, policy: DataFrame, rates: DataFrame) -> DataFrame:
    """One proposal per offer.

    offers: supplier, supplier_item_id, source_price, currency; catalog: supplier, product_id,
    current_price; policy: a row per supplier (vat_basis, rule_id, rule_version, approved,
    multiplier, max_delta_pct); rates: supplier, currency, rub_per_unit.  Policy and rates are
    bounded by suppliers times currencies and left to the optimizer to broadcast by size.
    """
    rows = (
        offers.select("supplier", "supplier_item_id", "source_price", "currency")
        .join(matches.select("supplier", "supplier_item_id", "catalog_product_id", F.col("status").alias("match_status")), ["supplier", "supplier_item_id"])
        .join(catalog.select("supplier", F.col("product_id").alias("catalog_product_id"), "current_price"), ["supplier", "catalog_product_id"], "left")
    )
    return propose_rows(rows, policy, rates)


def propose_rows(rows: DataFrame, policy: DataFrame, rates: DataFrame) -> DataFrame:
    """The same from rows (supplier, supplier_item_id, source_price, currency, catalog_product_id, match_status, current_price)."""
    rows = (
        rows.join(policy, "supplier", "left")
        .join(rates.select("supplier", "currency", "rub_per_unit"), ["supplier", "currency"], "left")
        .withColumn("current_price", F.coalesce("current_price", F.lit(0).cast("decimal(20,4)")))
    )
    no = lambda c: ~F.coalesce(c, F.lit(False))  # noqa: E731  null fails
    failing = [
        no((F.col("match_status") == "exact") & F.col("catalog_product_id").isNotNull()),
        no(F.col("source_price") > 0),
        no(F.col("currency").isin("RUB", "RUR")),
        no(F.col("rub_per_unit") > 0),
        no(F.col("rub_per_unit") == 1),
        no(F.col("vat_basis") != "unknown"),
        no(F.col("rule_id").isNotNull() & F.col("approved")),
        no(F.col("multiplier") > 0),
    ]
    block = F.lit(None).cast("int")
    for i in reversed(range(len(failing))):
        block = F.when(failing[i], F.lit(i)).otherwise(block)
    rows = rows.withColumn("block", block)
    open_ = F.col("block").isNull()
    money = "decimal(30,8)"
    rows = rows.withColumn("proposed_price", F.when(open_, (F.col("source_price") * F.col("multiplier")).cast(money)))
    rows = rows.withColumn("delta_abs", F.when(open_, F.col("proposed_price") - F.col("current_price").cast(money)))
    has_current = F.col("current_price") > 0
    # The gate compares without dividing, so the limit is met exactly.
    over = F.abs("delta_abs").cast("decimal(38,8)") * 100 > F.col("max_delta_pct").cast("decimal(9,2)") * F.col("current_price")
    status = F.when(open_ & ~has_current, "blocked_current_price").when(open_ & over, "blocked_delta").when(open_, "ready_for_review")
    warning = F.when(open_ & ~has_current, "nonpositive_current_price").when(open_ & over, "delta_exceeds_limit")
    for i, (name, why) in enumerate(BLOCKS):
        status = F.when(F.col("block") == i, name).otherwise(status)
        warning = F.when(F.col("block") == i, why).otherwise(warning)
    return rows.select(
        "supplier",
        "supplier_item_id",
        "catalog_product_id",
        "source_price",
        "currency",
        "current_price",
        "proposed_price",
        "delta_abs",
        F.when(open_ & has_current, F.col("delta_abs").cast("double") / F.col("current_price").cast("double")).alias("delta_pct"),
        F.when(open_, F.concat_ws("@", "rule_id", "rule_version")).alias("rule"),
        status.alias("status"),
        warning.alias("warning"),
    )


def policy_label(rule_id: Column, version: Column, approved: Column) -> Column:
    return F.when(approved & rule_id.isNotNull(), F.concat_ws("@", rule_id, version)).otherwise("not_approved")


def policy_rejects(policy: DataFrame, rates: DataFrame, base_multiplier: str = "1.10") -> DataFrame:
    """(supplier, rule) of policies that contradict themselves."""
    p = policy.join(rates.groupBy("supplier").agg(F.max(~F.col("currency").isin("RUB", "RUR")).alias("foreign"), F.max(F.col("rub_per_unit") != 1).alias("unequal")), "supplier", "left")
    rules = [
        ("publication_must_be_off", F.coalesce("publication", F.lit(False))),
        ("approved_markup_needs_vat_included", F.col("approved") & (F.col("vat_basis") != "included")),
        ("approved_markup_needs_rub_parity", F.col("approved") & (F.coalesce("foreign", F.lit(False)) | F.coalesce("unequal", F.lit(False)))),
        ("approved_markup_multiplier", F.col("approved") & (F.col("multiplier") != F.lit(base_multiplier).cast("decimal(9,4)"))),
        ("item_bounds", F.col("min_items") > F.col("max_items")),
    ]
    failed = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))
    return p.select("supplier", F.explode(failed).alias("rule"))
