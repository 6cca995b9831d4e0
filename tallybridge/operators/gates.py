"""Gates of a snapshot: what must hold of a feed as a whole before any of its rows is used.

A snapshot is a row of facts (``FACTS``), counted in the landed file (``sources.structure``).  Every gate
gives (supplier, rule, row_key) like the row rules, so that one supplier's broken feed blocks
that supplier and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.functions.text import SHA256_HEX, valid_feed_date

FACTS = "supplier, adapter, root, shops, offer_lists, currency_lists, category_lists, items, bytes, head, feed_date, content_sha256, source_sha256"
#: What a type of feed has once (fixed values): its root element.
ROOTS = {"11": "yml_catalog", "31": "xml_catalog", "41": "yml_catalog"}


def snapshot_gates(snapshots: DataFrame, policy: DataFrame) -> DataFrame:
    """(supplier, rule, row_key) of each gate a snapshot does not pass.

    snapshots: FACTS, with ``root_wanted`` and ``adapter`` as the adapter has them; policy:
    (supplier, min_items, max_items, max_bytes).  A fact that is null does not pass its gate;
    a snapshot without a policy row is rejected as such.  Facts that come from a file also have ``broken``.
    """
    rows = snapshots.join(policy.select("supplier", "min_items", "max_items", "max_bytes"), "supplier", "left")
    one = lambda c: F.col(c) == 1
    gates = [
        ("no_policy", F.col("min_items").isNotNull()),
        ("root_element", F.col("root") == F.col("root_wanted")),
        ("one_shop", one("shops")),
        ("one_offer_list", one("offer_lists")),
        ("one_currency_list", one("currency_lists")),
        ("at_most_one_category_list", F.col("category_lists") <= 1),
        ("item_count", F.col("min_items").isNull() | F.col("items").between(F.col("min_items"), F.col("max_items"))),
        ("byte_count", F.col("min_items").isNull() | (F.col("bytes") <= F.col("max_bytes"))),
        ("entity_declaration", ~F.col("head").rlike("(?i)<!ENTITY")),
        ("feed_date", valid_feed_date(F.col("feed_date"))),
        ("adapter_of_supplier", F.col("adapter") == F.col("supplier").cast("string")),
        ("content_hash_form", F.col("content_sha256").rlike(SHA256_HEX)),
        ("content_hash_equal", F.col("content_sha256") == F.col("source_sha256")),
    ]
    if "broken" in snapshots.columns:
        gates.append(("well_formed", ~F.col("broken")))
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in gates]))
    return rows.select("supplier", F.explode(failed).alias("rule"), F.col("content_sha256").alias("row_key"))


def sku_prefix(offers: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Offers whose generated SKU does not begin with the prefix of their supplier (supplier, prefix)."""
    wrong = offers.join(prefixes, "supplier", "left").where(~F.coalesce(F.col("catalog_sku").startswith(F.col("prefix")), F.lit(False)))
    return wrong.select("supplier", F.lit("sku_prefix").alias("rule"), F.col("supplier_item_id").cast("string").alias("row_key"))


def currency_declared(offers: DataFrame, currencies: DataFrame) -> DataFrame:
    """Offers in a currency that their feed (supplier, currency) does not declare, and suppliers
    that declare no currency or one with a rate that is not above 0."""
    known = currencies.select(F.col("supplier").alias("s"), F.col("currency").alias("c")).distinct()
    undeclared = offers.join(known, (F.col("supplier") == F.col("s")) & (F.col("currency") == F.col("c")), "left_anti")
    bad_rate = currencies.where(~F.coalesce(F.col("rate") > 0, F.lit(False)))
    none = offers.select("supplier").distinct().join(known.select(F.col("s").alias("supplier")).distinct(), "supplier", "left_anti")
    return (
        undeclared.select("supplier", F.lit("undeclared_currency").alias("rule"), F.col("supplier_item_id").cast("string").alias("row_key"))
        .union(bad_rate.select("supplier", F.lit("currency_rate"), F.col("currency")))
        .union(none.select("supplier", F.lit("no_currency"), F.lit(None).cast("string")))
    )


def refused_values(raw: DataFrame, key: str, tokens: list[str], decimals: list[str]) -> DataFrame:
    """Text that is set but no token of a boolean field, or no decimal of at most four places."""
    from tallybridge.functions.text import boolean_token, strict_decimal, strip

    filled = lambda c: F.coalesce(strip(F.col(c)), F.lit("")) != ""
    rules = [F.when(filled(c) & boolean_token(F.col(c)).isNull(), F.lit(f"token_{c}")) for c in tokens]
    rules += [F.when(filled(c) & strict_decimal(F.col(c)).isNull(), F.lit(f"decimal_{c}")) for c in decimals]
    return raw.select("supplier", F.explode(F.array_compact(F.array(*rules))).alias("rule"), F.col(key).cast("string").alias("row_key"))


def in_scope(catalog: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Catalogue rows of a supplier's scope: SKUs that begin with its prefix; applied after the row rules."""
    return catalog.join(prefixes, "supplier").where(F.col("sku").startswith(F.col("prefix"))).drop("prefix")


def accepted_run(offers: DataFrame, catalog: DataFrame, rejects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Offers and catalogue of the suppliers that no rule rejects: what a match may see."""
    bad = rejects.select("supplier").distinct()
    return offers.join(bad, "supplier", "left_anti"), catalog.join(bad, "supplier", "left_anti")
