"""Registered queries of landing: gates, files written and scanned back, policies, order of output.

Inputs are derived from the star-schema tables with faults at fixed remainders, so that every rule
is broken by some rows and kept by others.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions import text as T
from tallybridge.functions.store import fresh_folder, stored
from tallybridge.operators import audit, gates, match, missing, pricing, rejects, summary
from tallybridge.plans import catalogue
from tallybridge.plans.oracle import BASE, CATALOG, CATEGORY, MATCH, MISSING, PRICES, RUN_SUMMARY
from tallybridge.sinks import export
from tallybridge.sources import feeds, views
from tallybridge.sources.views import OFFERS_SQL
from tallybridge.streaming import missing_stream

SNAPSHOTS_SQL = """
SELECT k AS supplier, CASE WHEN k % 10 = 1 THEN '0' ELSE CAST(k AS STRING) END AS adapter,
  CASE WHEN k % 9 = 0 THEN 'html' ELSE 'yml_catalog' END AS root, 'yml_catalog' AS root_wanted,
  CASE WHEN k % 11 = 0 THEN 2 ELSE 1 END AS shops, CASE WHEN k % 13 = 0 THEN 2 ELSE 1 END AS offer_lists,
  CASE WHEN k % 14 = 0 THEN 0 ELSE 1 END AS currency_lists, k % 3 AS category_lists, coalesce(n, 0) AS items, coalesce(n, 0) * 1000 AS bytes,
  CASE WHEN k % 16 = 0 THEN '<!DOCTYPE a [<!entity b "c">]>' ELSE '<?xml version="1.0"?>' END AS head,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 18 = 0 THEN '2031-02-30 10:00' WHEN k % 23 = 0 THEN '2031-02-28' ELSE '2031-02-28 10:00' END AS feed_date,
  CASE WHEN k % 19 = 0 THEN 'x' ELSE HASH(CAST(k AS STRING)) END AS content_sha256,
  CASE WHEN k % 20 = 0 THEN HASH('other') WHEN k % 19 = 0 THEN 'x' ELSE HASH(CAST(k AS STRING)) END AS source_sha256
FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier) AS s
LEFT JOIN (SELECT l_suppkey AS j, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY l_suppkey) AS c ON j = k"""

BOUNDS_SQL = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier, 340 AS min_items, 385 AS max_items, CASE WHEN s_suppkey % 22 = 0 THEN 10 ELSE 1000000000 END AS max_bytes
FROM supplier WHERE s_suppkey % 21 <> 0"""

POLICY_SQL = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier, s_suppkey % 6 = 5 AS publication, CASE WHEN s_suppkey % 7 = 0 THEN 'unknown' ELSE 'included' END AS vat_basis,
  s_suppkey % 4 <> 0 AS approved, CAST(CASE WHEN s_suppkey % 9 = 0 THEN 1.25 ELSE 1.10 END AS DECIMAL(9, 4)) AS multiplier, CAST(25 AS DECIMAL(9, 2)) AS max_delta_pct,
  CASE WHEN s_suppkey % 8 <> 3 THEN 'base' END AS rule_id, CASE WHEN s_suppkey % 11 = 0 THEN 10 ELSE 1 END AS min_items, 5 AS max_items
FROM supplier"""

RATES_SQL = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier, CASE WHEN s_suppkey % 13 = 0 THEN 'USD' ELSE 'RUR' END AS currency,
  CAST(CASE WHEN s_suppkey % 17 = 0 THEN 2 ELSE 1 END AS DECIMAL(18, 8)) AS rub_per_unit
FROM supplier"""

CURRENCIES_SQL = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier, currency, CAST(CASE WHEN s_suppkey % 7 = 0 AND currency = 'USD' THEN 0 ELSE 1 END AS DECIMAL(18, 8)) AS rate
FROM supplier JOIN (SELECT 'RUR' AS currency UNION ALL SELECT 'USD') AS c ON s_suppkey % 6 <> 1 AND (currency = 'RUR' OR s_suppkey % 6 <> 0)"""

RAW_SQL = """
SELECT event_id % 97 AS supplier, event_id AS id,
  CASE event_id % 5 WHEN 0 THEN ' Yes' WHEN 1 THEN 'maybe' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE '-' END AS flag,
  CASE event_id % 7 WHEN 0 THEN '1.23456' WHEN 1 THEN '12.5' WHEN 2 THEN 'NaN' WHEN 3 THEN '' WHEN 4 THEN '1.2300000' WHEN 5 THEN '1,5' ELSE ' 7 ' END AS amount
FROM events"""

STATE_SQL = """
SELECT CAST(o_custkey AS BIGINT) AS supplier, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey AS BIGINT) END AS product_id,
  CASE WHEN o_orderkey % 13 = 0 THEN '' WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS sku,
  CAST(o_orderkey % 19 AS INT) - 1 AS consecutive_missing_runs
FROM orders"""

RUNS_SQL = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier, s_suppkey % 5 <> 0 AS read_only, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey % 3 <> 0 END AS feed_complete,
  HASH(CAST(s_suppkey AS STRING)) AS summary_sha256, HASH(concat('p', CAST(s_suppkey AS STRING))) AS policy_sha256
FROM supplier"""


#: HASH(..), with two levels of brackets inside, is what the engines call by other names.
_HASH = re.compile(r"HASH\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*)\)")


def _spark(spark: SparkSession, sf: str, sql: str, *names: str) -> DataFrame:
    return views.derived(spark, sf, _HASH.sub(r"sha2(\1, 256)", sql), names)


def _duck(sql: str) -> str:
    return sql.replace("HASH(", "sha256(")


def _snapshot_rejects(spark, sf) -> DataFrame:
    return gates.snapshot_gates(_spark(spark, sf, SNAPSHOTS_SQL, "supplier", "lineitem"), _spark(spark, sf, BOUNDS_SQL, "supplier"))


def snapshot_gates(spark, sf):
    return _snapshot_rejects(spark, sf)


SNAPSHOT_GATES = f"""snap AS (SELECT p.*, b.min_items, b.max_items, b.max_bytes FROM ({_duck(SNAPSHOTS_SQL)}) p LEFT JOIN ({BOUNDS_SQL}) b USING (supplier)),
gate_rejects AS (SELECT supplier, rule, content_sha256 AS row_key FROM (SELECT *, unnest([
  CASE WHEN min_items IS NULL THEN 'no_policy' END, CASE WHEN root <> root_wanted THEN 'root_element' END, CASE WHEN shops <> 1 THEN 'one_shop' END,
  CASE WHEN offer_lists <> 1 THEN 'one_offer_list' END, CASE WHEN currency_lists <> 1 THEN 'one_currency_list' END, CASE WHEN category_lists > 1 THEN 'at_most_one_category_list' END,
  CASE WHEN items < min_items OR items > max_items THEN 'item_count' END, CASE WHEN bytes > max_bytes THEN 'byte_count' END,
  CASE WHEN contains(lower(head), '<!entity') THEN 'entity_declaration' END,
  CASE WHEN feed_date IS NULL OR length(feed_date) <> 16 OR try_strptime(feed_date, '%Y-%m-%d %H:%M') IS NULL THEN 'feed_date' END,
  CASE WHEN adapter <> CAST(supplier AS VARCHAR) THEN 'adapter_of_supplier' END, CASE WHEN NOT regexp_full_match(content_sha256, '[0-9a-f]{{64}}') THEN 'content_hash_form' END,
  CASE WHEN content_sha256 <> source_sha256 THEN 'content_hash_equal' END]) AS rule FROM snap) WHERE rule IS NOT NULL)"""


def accepted_run(spark, sf):
    """A run that fails closed: what any rule rejects never reaches the match."""
    offers, catalog = catalogue.offers_of(spark, sf), catalogue.catalog_of(spark, sf)
    raw = offers.union(offers.where("supplier % 8 = 3 and feed_pos % 10 = 5"))
    bad = rejects.duplicates(raw, "duplicate_item", "supplier_item_id").union(rejects.duplicates(catalog, "duplicate_product", "product_id")).union(_snapshot_rejects(spark, sf).where("rule in ('item_count', 'entity_declaration', 'one_shop')"))
    offers, catalog = gates.accepted_run(raw, catalog, bad)
    return match.match(offers, catalog).groupBy("supplier", "status").agg(F.count("*").alias("n"))


_ACCEPTED = MATCH.replace(
    f"WITH offers AS ({OFFERS_SQL}), catalog AS (",
    f"WITH {SNAPSHOT_GATES}, every_offer AS ({OFFERS_SQL}), bad AS (SELECT supplier FROM gate_rejects WHERE rule IN ('item_count', 'entity_declaration', 'one_shop') UNION SELECT supplier FROM every_offer WHERE supplier % 8 = 3 AND feed_pos % 10 = 5), "
    "offers AS (SELECT * FROM every_offer WHERE supplier NOT IN (SELECT supplier FROM bad)), catalog AS (",
)


def currency_gates(spark, sf):
    return gates.currency_declared(catalogue.offers_of(spark, sf), _spark(spark, sf, CURRENCIES_SQL, "supplier"))


def refused_values(spark, sf):
    return gates.refused_values(_spark(spark, sf, RAW_SQL, "events"), "id", ["flag"], ["amount"])


def catalog_scope(spark, sf):
    """Products of a supplier's prefix; half of the suppliers have a narrower one."""
    catalog = catalogue.catalog_of(spark, sf)
    own = F.col("supplier").cast("string")
    prefixes = catalog.select("supplier", F.concat(own, F.when(F.col("supplier") % 2 == 0, "-").otherwise("-1")).alias("prefix")).distinct()
    return gates.in_scope(catalog, prefixes).select("supplier", "product_id", "sku")


def sku_prefix_gate(spark, sf):
    offers = catalogue.offers_of(spark, sf)
    prefixes = offers.select("supplier", F.concat(F.when(F.col("supplier") % 10 == 4, "x").otherwise(""), F.col("supplier").cast("string"), F.lit("-")).alias("prefix")).distinct()
    return gates.sku_prefix(offers, prefixes)


def category_keys(spark, sf):
    part = views.star(spark, sf, "part")["part"]
    name, kind = F.col("p_name"), F.col("p_type")
    given = F.when(F.col("p_partkey") % 3 == 0, F.to_json(F.array(kind, name))).when(F.col("p_partkey") % 3 == 1, name).otherwise(F.concat(F.lit("["), name))
    return part.select("p_partkey", T.category_key(given).alias("category_key"))


def _policy(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The policies as landed: written as JSON files and scanned back with their schema."""
    folder = fresh_folder(spark, "policy")
    tables = []
    for name, sql in (("policy", POLICY_SQL), ("rates", RATES_SQL)):
        rows = _spark(spark, sf, sql, "supplier")
        export.write_jsonl(rows, f"{folder}/{name}")
        tables.append(spark.read.schema(rows.schema).json(f"{folder}/{name}").select(*rows.columns))
    return tables[0], tables[1]


def policy_gates(spark, sf):
    return pricing.policy_rejects(*_policy(spark, sf))


def policy_hashes(spark, sf):
    """The hash that binds a policy, and whether the one recorded with a run is still that of the file."""
    policy, _ = _policy(spark, sf)
    now = policy.select("supplier", F.sha2(T.canonical_json(["vat_basis", "max_delta_pct", "rule_id"]), 256).alias("policy_sha256"))
    recorded = now.select("supplier", F.when(F.col("supplier") % 5 == 0, F.sha2(F.lit("before"), 256)).otherwise(F.col("policy_sha256")).alias("recorded"))
    return now.join(recorded, "supplier").select("supplier", "policy_sha256", (F.col("policy_sha256") == F.col("recorded")).alias("unchanged"))


def policy_labels(spark, sf):
    policy, _ = _policy(spark, sf)
    return policy.select("supplier", pricing.policy_label(F.col("rule_id"), F.lit("1"), F.col("approved")).alias("label"))


def state_rejects(spark, sf):
    return missing.state_rejects(_spark(spark, sf, STATE_SQL, "orders")).groupBy("supplier", "rule").agg(F.count("*").alias("n"))


def approvals(spark, sf):
    rows = audit.approval_rows(_spark(spark, sf, RUNS_SQL, "supplier"))
    return rows.select("supplier", "eligible", F.array_join("blockers", ",").alias("blockers"), "approval", "summary_sha256", "policy_sha256")


def promoted_state(spark, sf):
    """Of the suppliers whose run passed: how many rows of the new state replace the current one."""
    batch = catalogue.QUERIES["batch_status"](spark, sf)
    state = views.seen(spark, sf).select("supplier", "product_id").distinct()
    return audit.promote_state(state, batch).groupBy("supplier").agg(F.count("*").alias("n"))


def batch_exit(spark, sf):
    return rejects.exit_status(catalogue.QUERIES["batch_status"](spark, sf))


def run_reports(spark, sf):
    return summary.report_lines(catalogue.QUERIES["run_summary"](spark, sf))


def missing_in_order(spark, sf):
    """Missing products by supplier and id, with their place."""
    rows = catalogue.QUERIES["catalog_missing"](spark, sf)
    return export.with_positions(rows, ["supplier", "product_id"]).select("position", "supplier", "product_id")


def categories_in_order(spark, sf):
    """Categories of the offers, with their place: a mapping has a row for each, whatever it is mapped to, so none is made.  They are
    written first, as the ranges are told from a pass of their own."""
    rows = views.offers_from(views.pairs(spark, sf)).select("supplier", "category_1", "category_2").distinct()
    return export.with_positions(stored(rows, "categories"), ["supplier", "category_1", "category_2"])


def actions_in_order(spark, sf):
    """Proposed actions by product id as text."""
    rows = catalogue.QUERIES["quarantine_proposals"](spark, sf).select("supplier", F.col("product_id").cast("string").alias("product_id"))
    return export.with_positions(rows, ["supplier", "product_id"])


def offers_in_feed_order(spark, sf):
    rows = catalogue.offers_of(spark, sf).select("supplier", "feed_pos", "supplier_item_id")
    return export.with_positions(rows, ["supplier", "feed_pos"])


def copies_parity(spark, sf):
    """Where two copies of a list, by place, do not agree."""
    orders = views.star(spark, sf, "orders")["orders"]
    a = orders.select(F.col("o_orderkey").alias("position"), F.col("o_custkey").cast("string").alias("id"))
    b = a.where("position % 101 <> 7").withColumn("id", F.when(F.col("position") % 103 == 5, "other").otherwise(F.col("id")))
    return audit.parity(a, b)


def sku_audit(spark, sf):
    """SKUs that feed and catalogue share directly, by supplier."""
    offers, catalog = catalogue.offers_of(spark, sf), catalogue.catalog_of(spark, sf)
    return audit.shared_skus(offers, catalog)


def manifest_audit(spark, sf):
    part = views.star(spark, sf, "part")["part"]
    n = F.col("p_partkey") % 12
    listing = part.select(F.concat(F.lit("in/"), F.col("p_partkey").cast("string")).alias("path"), F.sha2("p_name", 256).alias("sha256"), F.col("p_partkey").cast("long").alias("size"), n.alias("n"))
    bundle = listing.where("n <> 1").withColumn("size", F.when(F.col("n") == 2, 0).otherwise(F.col("size")))
    external = listing.where("n <> 3").withColumn("sha256", F.when(F.col("n") == 4, "x").otherwise(F.col("sha256")))
    return audit.manifest_inputs(listing.drop("n"), bundle.drop("n"), external.drop("n")).groupBy("status").agg(F.count("*").alias("n"))


#: Offers of a written feed file: an XML file is read by one task, whole.
OFFERS_A_FILE = 100_000


def _files(df: DataFrame, what: str, root: str = "offers") -> str:
    path = fresh_folder(df.sparkSession, what)
    df.write.format("xml").option("maxRecordsPerFile", OFFERS_A_FILE).option("rootTag", root).option("rowTag", "offer").save(path)
    return path


def feed_files_11(spark, sf):
    """Offers written as XML files of the first dialect, scanned and typed."""
    cents = F.format_string("%d.%02d", F.floor(F.col("price_cents") / 100).cast("long"), (F.col("price_cents") % 100).cast("long"))
    rows = catalogue.offers_of(spark, sf).select(F.concat_ws("/", "supplier", "supplier_item_id").alias("_id"), F.col("available").cast("string").alias("_available"), F.when(F.col("price_cents") > 0, cents).alias("price"), F.col("currency").alias("currencyId"), F.concat("name", F.lit(" <2 m & more")).alias("name"), F.col("manufacturer").alias("vendor"), F.col("mpn").alias("vendorCode"), F.col("ean").alias("barcode"))
    m = feeds.DIALECTS["11"]
    typed = feeds.normalise(feeds.read_offers(spark, _files(rows, "feed-11"), m), m)
    key = F.split("supplier_item_id", "/")
    return typed.select(key[0].cast("long").alias("supplier"), key[1].alias("supplier_item_id"), "name", "manufacturer", "mpn", "ean", (F.col("source_price") * 100).cast("long").alias("price_cents"), F.col("currencyId").alias("currency"), "available", F.size("refused").cast("long").alias("n_refused"))


def feed_files_31(spark, sf):
    """The second dialect: stock symbols, prices that must be above 0, stock that decides."""
    k = F.col("feed_pos")
    stock = F.when(k % 4 == 0, "***").when(k % 4 == 1, (k % 5 - 2).cast("string")).when(k % 4 == 2, "many")
    rows = catalogue.offers_of(spark, sf).select(F.concat_ws("/", "supplier", "supplier_item_id").alias("_id"), F.when(k % 6 == 0, "+").when(k % 6 == 1, "perhaps").alias("_available"), F.col("price_cents").cast("string").alias("priceE"), F.col("manufacturer").alias("Vendor"), F.col("mpn").alias("PN"), F.col("ean").alias("GTIN"), stock.alias("count"), F.when(k % 10 == 0, "1").alias("OutOfProd"))
    m = feeds.DIALECTS["31"]
    typed = feeds.normalise(feeds.read_offers(spark, _files(rows, "feed-31"), m), m)
    key = F.split("supplier_item_id", "/")
    return typed.select(key[0].cast("long").alias("supplier"), key[1].alias("supplier_item_id"), F.col("source_price").cast("long").alias("price"), "quantity", "available", F.array_join(F.array_sort("refused"), ",").alias("refused"))


def catalog_file(spark, sf):
    """The catalogue written as CSV, scanned as text, checked row by row and typed."""
    folder = fresh_folder(spark, "catalog")
    rows = catalogue.catalog_of(spark, sf).withColumn("price", F.when(F.col("product_id") % 53 == 0, "cheap").otherwise(F.col("price_cents").cast("string")))
    export.write_csv(rows, folder, feeds.CATALOG_HEADERS)
    back = feeds.read_catalog(spark, folder)
    bad = rejects.catalog_rows(back.withColumn("supplier", F.lit(0)))
    good = back.join(bad.select(F.col("row_key").alias("product_id")).distinct(), "product_id", "left_anti")
    return good.select(F.col("product_id").cast("long").alias("product_id"), "sku", F.col("price").cast("long").alias("price"), F.col("quantity").cast("long").alias("quantity"))


def jsonl_file(spark, sf):
    folder = fresh_folder(spark, "jsonl")
    rows = catalogue.offers_of(spark, sf).select("supplier", "supplier_item_id", "category_path", "ean")
    export.write_jsonl(rows, folder)
    back = spark.read.schema(rows.schema).json(folder)
    return back.select("supplier", "supplier_item_id", F.array_join("category_path", "/").alias("path"), "ean")


def _broken_checks(r: catalogue._Run) -> DataFrame:
    """The checks of a run whose tables are spoiled, another one for each remainder of the supplier by 7."""
    turn = F.col("supplier") % 7
    matches = r.matches.where(~((turn == 1) & (F.col("feed_pos") % 9 == 0))).withColumn("warnings", F.when(turn == 2, F.array().cast("array<string>")).otherwise(F.col("warnings")))
    priced = F.when((turn == 3) & (F.col("status") == "blocked_match"), F.lit(1)).when((turn == 5) & (F.col("status") == "ready_for_review"), F.lit(-1)).otherwise(F.col("proposed_price"))
    mapped = r.mapped().withColumn("publication_eligible", turn == 4)
    return audit.verify(r.offers, matches, r.proposals().withColumn("proposed_price", priced.cast("decimal(38,8)")), mapped)


def verify_broken(spark, sf):
    """Which checks fail where."""
    return _broken_checks(catalogue._Run(spark, sf, catalogue._PRICES, catalogue._CATEGORIES)).where("not passed").select("supplier", "name")


def source_audits(spark, sf):
    """Audits of a run's sources and prices; some suppliers have only roubles, some a price of 0."""
    r = catalogue._Run(spark, sf, catalogue._PRICES)
    offers = r.offers.where("supplier % 3 <> 0 or currency = 'RUR'").where("supplier % 2 <> 0 or price_cents > 0")
    proposals = r.proposals().where("supplier % 5 <> 0 or proposed_price is null")
    return audit.source_audits(offers, proposals).withColumn("detail", F.when(F.col("name") == "source_prices_positive", (F.col("detail").cast("decimal(20,4)") * 100).cast("long").cast("string")).otherwise(F.col("detail")))


def batch_status_broken(spark, sf):
    r = catalogue._Run(spark, sf, catalogue._PRICES, catalogue._CATEGORIES)
    return rejects.batch_status(r.offers, catalogue._price_rejects(r.offers).where("supplier % 2 = 0"), _broken_checks(r))


def completeness_ratios(spark, sf):
    r = catalogue._Run(spark, sf)
    rows = summary.completeness(r.offers, r.catalog, r.missing())
    return rows.select("supplier", *[F.round(F.col(c) * 1_000_000).cast("long").alias(c) for c in ("source_ratio", "covered_ratio")])


def category_alternatives(spark, sf):
    """Every target of a category in its rank, and the share of the first in hundredths of a per cent."""
    mapped = catalogue._Run(spark, sf, catalogue._CATEGORIES).mapped()
    rows = mapped.select("supplier", F.col("category_path")[0].alias("category_1"), F.col("category_path")[1].alias("category_2"), (F.col("dominance_pct") * 100).cast("decimal(20,2)").cast("long").alias("dominance"), F.posexplode("alternatives").alias("rank", "a"))
    return rows.select("supplier", "category_1", "category_2", "dominance", F.col("rank").cast("long").alias("rank"), "a.category_ids", "a.categories", "a.support")


def landing_stream(spark, sf):
    """Landings as a stream of files, the second of which repeats content of the first."""
    folder = fresh_folder(spark, "landings")
    rows = views.star(spark, sf, "orders")["orders"].select(F.col("o_custkey").cast("long").alias("supplier"), (F.col("o_orderkey") % 5).cast("string").alias("content_sha256"), F.to_timestamp("o_orderdate").alias("landed_at"), (F.col("o_orderkey") % 2).alias("half"))
    for half in (0, 1):
        rows.where(F.col("half") == half).drop("half").write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.drop("half").schema).option("maxFilesPerTrigger", 4).parquet(f"{folder}/in")
    once = missing_stream.dedupe_landing(stream, "10000 days")
    once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.drop("half").schema).parquet(f"{folder}/out").select("supplier", "content_sha256")


def committed_runs(spark, sf):
    """Rows written by run, of which only runs with a manifest row are read."""
    folder = fresh_folder(spark, "runs")
    rows = views.star(spark, sf, "nation")["nation"].select(F.col("n_nationkey").cast("long").alias("n"), "n_name")
    for run in ("a", "b", "a"):
        export.write_run(rows.where("n % 2 = 0") if run == "a" else rows, f"{folder}/rows", run)
    export.write_manifest(spark.createDataFrame([("a",)], "run_id string"), f"{folder}/manifest")
    return export.read_committed(spark.read.parquet(f"{folder}/rows"), spark.read.parquet(f"{folder}/manifest")).select("run_id", "n", "n_name")


def landed_bytes(spark, sf):
    """Files as landed, by name: their bytes and hash, two copies of one content alike."""
    folder = fresh_folder(spark, "bytes")
    nation = views.star(spark, sf, "nation")["nation"].select(F.col("n_name").alias("value"), F.col("n_nationkey").cast("string").alias("name"))
    nation.repartition("name").write.partitionBy("name").text(folder)
    files = feeds.read_bytes(spark, folder, recursive=True)
    return files.select(F.regexp_extract("path", "name=([0-9]+)/", 1).cast("long").alias("name"), "size", "sha256")


_ALL = [
    snapshot_gates, accepted_run, currency_gates, refused_values, catalog_scope, sku_prefix_gate, category_keys, policy_gates, policy_hashes, policy_labels,
    state_rejects, approvals, promoted_state, batch_exit, run_reports, missing_in_order, categories_in_order, actions_in_order, offers_in_feed_order,
    copies_parity, sku_audit, manifest_audit, feed_files_11, feed_files_31, catalog_file, jsonl_file, landed_bytes,
    verify_broken, source_audits, batch_status_broken, completeness_ratios, category_alternatives, landing_stream, committed_runs,
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in _ALL}


def _unnest(cases: list[tuple[str, str]]) -> str:
    return "unnest([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in cases) + "])"


_BATCH = f"{BASE}, bad AS (SELECT DISTINCT supplier FROM offers WHERE price_cents = 0 AND currency = 'USD')"
_POLICY_RULES = _unnest([
    ("publication_must_be_off", "publication"), ("approved_markup_needs_vat_included", "approved AND vat_basis <> 'included'"),
    ("approved_markup_needs_rub_parity", "approved AND (currency NOT IN ('RUB', 'RUR') OR rub_per_unit <> 1)"), ("approved_markup_multiplier", "approved AND multiplier <> 1.10"), ("item_bounds", "min_items > max_items"),
])
_BROKEN = f"""{PRICES}, failed AS (
  SELECT DISTINCT supplier, 'a_match_per_offer' AS name FROM offers WHERE supplier % 7 = 1 AND feed_pos % 9 = 0
  UNION SELECT supplier, 'conflicts_say_why' FROM matches WHERE supplier % 7 = 2 AND status = 'conflict'
  UNION SELECT supplier, 'no_price_when_blocked' FROM proposals WHERE supplier % 7 = 3 AND status = 'blocked_match'
  UNION SELECT supplier, 'prices_positive' FROM proposals WHERE supplier % 7 = 5 AND status = 'ready_for_review'
  UNION SELECT supplier, 'categories_not_published' FROM offers WHERE supplier % 7 = 4)"""
_STOCK = "CASE WHEN feed_pos % 4 = 1 THEN feed_pos % 5 - 2 END"

ORACLE: dict[str, str] = {
    "snapshot_gates": f"WITH {SNAPSHOT_GATES} SELECT supplier, rule, row_key FROM gate_rejects",
    "accepted_run": f"{_ACCEPTED} SELECT supplier, status, count(*) AS n FROM matches GROUP BY ALL",
    "currency_gates": f"{BASE}, cur AS ({CURRENCIES_SQL}) SELECT supplier, 'undeclared_currency' AS rule, supplier_item_id AS row_key FROM offers o WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.supplier = o.supplier AND cur.currency = o.currency) UNION ALL SELECT supplier, 'currency_rate', currency FROM cur WHERE rate <= 0 UNION ALL SELECT DISTINCT supplier, 'no_currency', NULL FROM offers WHERE supplier NOT IN (SELECT supplier FROM cur)",
    "refused_values": f"SELECT supplier, rule, CAST(id AS VARCHAR) AS row_key FROM (SELECT supplier, id, {_unnest([('token_flag', "flag = 'maybe'"), ('decimal_amount', "amount IN ('1.23456', 'NaN', '1,5')")])} AS rule FROM ({RAW_SQL})) WHERE rule IS NOT NULL",
    "catalog_scope": f"{BASE} SELECT supplier, product_id, sku FROM catalog WHERE starts_with(sku, CAST(supplier AS VARCHAR) || CASE WHEN supplier % 2 = 0 THEN '-' ELSE '-1' END)",
    "sku_prefix_gate": f"{BASE} SELECT supplier, 'sku_prefix' AS rule, supplier_item_id AS row_key FROM offers WHERE supplier % 10 = 4",
    "category_keys": "SELECT p_partkey, CAST(to_json(CASE p_partkey % 3 WHEN 0 THEN [p_type, p_name] WHEN 1 THEN [p_name] ELSE ['[' || p_name] END) AS VARCHAR) AS category_key FROM part",
    "policy_gates": f"SELECT supplier, rule FROM (SELECT supplier, {_POLICY_RULES} AS rule FROM ({POLICY_SQL}) JOIN ({RATES_SQL}) USING (supplier)) WHERE rule IS NOT NULL",
    "policy_hashes": f"SELECT supplier, sha256('{{\"max_delta_pct\":25.00,\"rule_id\":' || coalesce('\"' || rule_id || '\"', 'null') || ',\"vat_basis\":\"' || vat_basis || '\"}}') AS policy_sha256, supplier % 5 <> 0 AS unchanged FROM ({POLICY_SQL})",
    "policy_labels": f"SELECT supplier, CASE WHEN approved AND rule_id IS NOT NULL THEN rule_id || '@1' ELSE 'not_approved' END AS label FROM ({POLICY_SQL})",
    "state_rejects": f"SELECT supplier, rule, count(*) AS n FROM (SELECT supplier, {_unnest([('blank_product', 'product_id IS NULL'), ('blank_sku', "coalesce(sku, '') = ''"), ('negative_count', 'consecutive_missing_runs < 0')])} AS rule FROM ({STATE_SQL})) WHERE rule IS NOT NULL GROUP BY ALL",
    "approvals": f"SELECT supplier, read_only AND coalesce(feed_complete, false) AS eligible, concat_ws(',', CASE WHEN NOT read_only THEN 'run_not_read_only' END, CASE WHEN NOT coalesce(feed_complete, false) THEN 'feed_incomplete' END) AS blockers, 'pending' AS approval, summary_sha256, policy_sha256 FROM ({_duck(RUNS_SQL)})",
    "promoted_state": f"{_BATCH} SELECT l_suppkey AS supplier, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_suppkey IN (SELECT supplier FROM offers) AND l_suppkey NOT IN (SELECT supplier FROM bad) GROUP BY l_suppkey",
    "batch_exit": f"{_BATCH}, st AS (SELECT supplier, supplier IN (SELECT supplier FROM bad) AS blocked FROM (SELECT DISTINCT supplier FROM offers)) SELECT count(*) FILTER (NOT blocked) AS passed, count(*) FILTER (blocked) AS blocked, CAST(0 AS BIGINT) AS failed, CAST(max(CASE WHEN blocked THEN 1 ELSE 0 END) AS INTEGER) AS exit_code FROM st",
    "run_reports": f"SELECT supplier, '# Supplier ' || supplier || chr(10) || concat_ws(chr(10), {', '.join(f"'- {c}: ' || {c}" for c in 'source_items source_available exact source_only review ready missing'.split())}) AS report FROM ({RUN_SUMMARY})",
    "missing_in_order": f"{MISSING} SELECT row_number() OVER (ORDER BY supplier, product_id) AS position, supplier, product_id FROM missing",
    "categories_in_order": f"{BASE} SELECT row_number() OVER (ORDER BY supplier, category_1, category_2) AS position, supplier, category_1, category_2 FROM (SELECT DISTINCT supplier, category_1, category_2 FROM offers)",
    "actions_in_order": f"SELECT row_number() OVER (ORDER BY supplier, product_id) AS position, supplier, product_id FROM (SELECT supplier, CAST(product_id AS VARCHAR) AS product_id FROM ({CATALOG['quarantine_proposals']}))",
    "offers_in_feed_order": f"{BASE} SELECT row_number() OVER (ORDER BY supplier, feed_pos) AS position, supplier, feed_pos, supplier_item_id FROM offers",
    "copies_parity": "SELECT o_orderkey AS position, CASE WHEN o_orderkey % 101 = 7 THEN 'only_first' ELSE 'differs' END AS status FROM orders WHERE o_orderkey % 101 = 7 OR o_orderkey % 103 = 5",
    "sku_audit": f"{BASE} SELECT supplier, count(*) AS n FROM (SELECT DISTINCT supplier, catalog_sku AS sku FROM offers INTERSECT SELECT supplier, sku FROM catalog) GROUP BY supplier",
    "manifest_audit": "SELECT status, count(*) AS n FROM (SELECT CASE p_partkey % 12 WHEN 1 THEN 'not_in_bundle' WHEN 2 THEN 'bundle_differs' WHEN 3 THEN 'no_external_file' WHEN 4 THEN 'external_differs' ELSE 'ok' END AS status FROM part) GROUP BY status",
    "feed_files_11": f"{BASE} SELECT supplier, supplier_item_id, name || ' <2 m & more' AS name, manufacturer, mpn, ean, price_cents, currency, available, CAST(0 AS BIGINT) AS n_refused FROM offers",
    "feed_files_31": f"""{BASE} SELECT supplier, supplier_item_id, price_cents AS price, CAST({_STOCK} AS INTEGER) AS quantity,
  CASE WHEN feed_pos % 10 = 0 OR {_STOCK} <= 0 THEN false WHEN feed_pos % 6 = 0 THEN true WHEN feed_pos % 4 = 1 THEN {_STOCK} > 0 WHEN feed_pos % 4 = 0 THEN true END AS available,
  concat_ws(',', CASE WHEN feed_pos % 6 = 1 THEN 'available_token' END, CASE WHEN price_cents <= 0 THEN 'price_not_positive' END, CASE WHEN feed_pos % 4 = 2 THEN 'stock_number' END) AS refused FROM offers""",
    "catalog_file": f"{BASE} SELECT product_id, sku, price_cents AS price, quantity FROM catalog WHERE product_id % 53 <> 0",
    "jsonl_file": f"{BASE} SELECT supplier, supplier_item_id, category_1 || '/' || category_2 AS path, ean FROM offers",
    "verify_broken": f"{_BROKEN} SELECT supplier, name FROM failed",
    "source_audits": f"""{PRICES}, kept AS (SELECT * FROM offers WHERE (supplier % 3 <> 0 OR currency = 'RUR') AND (supplier % 2 <> 0 OR price_cents > 0)),
priced AS (SELECT supplier, count(proposed_e4) AS n FROM proposals WHERE supplier % 5 <> 0 OR proposed_e4 IS NULL GROUP BY supplier)
SELECT supplier, 'source_prices_positive' AS name, min(price_cents) > 0 AS passed, CAST(min(price_cents) AS VARCHAR) AS detail FROM kept GROUP BY supplier
UNION ALL SELECT supplier, 'source_currency_known', bool_and(currency = 'RUR'), array_to_string(list_sort(list(DISTINCT currency)), ',') FROM kept GROUP BY supplier
UNION ALL SELECT supplier, 'no_calculated_prices', coalesce(n, 0) = 0, CAST(coalesce(n, 0) AS VARCHAR) FROM (SELECT DISTINCT supplier FROM kept) LEFT JOIN priced USING (supplier)""",
    "batch_status_broken": f"{_BROKEN}, bad AS (SELECT DISTINCT supplier FROM offers WHERE price_cents = 0 AND currency = 'USD' AND supplier % 2 = 0) SELECT supplier, CASE WHEN supplier IN (SELECT supplier FROM bad) THEN 'BLOCKED' WHEN supplier IN (SELECT supplier FROM failed) THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT DISTINCT supplier FROM offers)",
    "completeness_ratios": f"{MISSING} SELECT supplier, CAST(round(1000000.0 * (SELECT count(*) FROM offers o WHERE o.supplier = c.supplier) / count(*)) AS BIGINT) AS source_ratio, CAST(round(1000000.0 * (count(*) - (SELECT count(*) FROM missing m WHERE m.supplier = c.supplier)) / count(*)) AS BIGINT) AS covered_ratio FROM catalog c GROUP BY supplier",
    "category_alternatives": f"{CATEGORY} SELECT supplier, category_1, category_2, CAST(round_even(10000.0 * max(support) OVER (PARTITION BY supplier, category_1, category_2) / tsup, 0) AS BIGINT) AS dominance, rn - 1 AS rank, category_ids, categories, support FROM rk",
    "landing_stream": "SELECT DISTINCT CAST(o_custkey AS BIGINT) AS supplier, CAST(o_orderkey % 5 AS VARCHAR) AS content_sha256 FROM orders",
    "committed_runs": "SELECT 'a' AS run_id, CAST(n_nationkey AS BIGINT) AS n, n_name FROM nation WHERE n_nationkey % 2 = 0",
    "landed_bytes": "SELECT CAST(n_nationkey AS BIGINT) AS name, CAST(length(n_name) + 1 AS BIGINT) AS size, sha256(n_name || chr(10)) AS sha256 FROM nation",
}
