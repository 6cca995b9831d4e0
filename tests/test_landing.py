"""Gates, digests, order and audits on rows that break them."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybridge.functions import store
from tallybridge.operators import audit, gates, match, missing
from tallybridge.plans import catalogue, landing
from tallybridge.sinks import export


def test_digest_tells_rows_apart(spark, monkeypatch):
    rows = [(i % 40, f"t{i % 7}") for i in range(300)]
    digest = lambda r: spark.createDataFrame(r, "a int, b string").transform(audit.table_digest).first()
    one = digest(rows)
    assert one == digest(rows[::-1]) and one["n_rows"] == 300
    assert one["digest"] != digest(rows + rows[:1])["digest"] and one["digest"] != digest([(a + (a == 7), b) for a, b in rows])["digest"]
    assert digest([])["n_rows"] == 0
    monkeypatch.setattr(audit, "DIGEST_ROWS", 1)
    monkeypatch.setattr(audit, "DIGEST_FOLD", 1)
    several = digest(rows)
    assert several == digest(rows[::-1]) and several["digest"] != digest(rows[:-1])["digest"]


def test_positions_are_those_of_the_order(spark):
    df = spark.range(1000).select((F.hash("id") % 5000).alias("k"), "id").repartition(7)
    got = {r["id"]: r["position"] for r in export.with_positions(df, ["k", "id"]).collect()}
    want = [r["id"] for r in df.orderBy("k", "id").collect()]
    assert [got[i] for i in want] == list(range(1, 1001))
    assert export.with_positions(df.limit(0), ["k"]).count() == 0


def test_categories_are_ordered_without_a_match(spark, sf, monkeypatch):
    mapped = catalogue.category_mapping(spark, sf).select("supplier", "category_1", "category_2")
    monkeypatch.setattr(match, "match", None)
    got = landing.categories_in_order(spark, sf)
    assert got.drop("position").exceptAll(mapped).isEmpty() and mapped.exceptAll(got.drop("position")).isEmpty()


def test_gates_reject_null_facts(spark):
    good = dict(supplier=1, adapter="1", root="a", root_wanted="a", shops=1, offer_lists=1, currency_lists=1, category_lists=0, items=5, bytes=9, head="<?xml?>", feed_date="2031-02-28 10:00", content_sha256=hashlib.sha256(b"").hexdigest(), source_sha256=hashlib.sha256(b"").hexdigest())
    kind = "supplier int, adapter string, root string, root_wanted string, shops int, offer_lists int, currency_lists int, category_lists int, items int, bytes int, head string, feed_date string, content_sha256 string, source_sha256 string"
    policy = spark.createDataFrame([(1, 1, 5, 9), (2, 1, 5, 9)], "supplier int, min_items int, max_items int, max_bytes int")
    said = lambda **change: sorted(r["rule"] for r in gates.snapshot_gates(spark.createDataFrame([{**good, **change}], kind), policy).collect())
    assert said() == []
    assert said(items=6, bytes=10) == ["byte_count", "item_count"] and said(items=None) == ["item_count"]
    assert said(head='<!DOCTYPE x [<!ENTITY a "b">]>', shops=2) == ["entity_declaration", "one_shop"]
    assert said(feed_date=None, root=None, source_sha256=None) == ["content_hash_equal", "feed_date", "root_element"]
    assert said(supplier=3) == ["adapter_of_supplier", "no_policy"]


def test_a_rejected_supplier_never_reaches_the_match(spark):
    offers = spark.createDataFrame([(s, f"{i}", i, f"{s}-{i}", None, None, "b", "m", []) for s in (1, 2) for i in range(3)], "supplier long, supplier_item_id string, feed_pos long, catalog_sku string, ean string, mpn string, manufacturer string, model string, identity_warnings array<string>")
    catalog = spark.createDataFrame([(s, s * 10 + i, f"{s}-{i}", None, "m", "b") for s in (1, 2) for i in range(3)], "supplier long, product_id long, sku string, ean string, model string, manufacturer string")
    bad = spark.createDataFrame([(2, "duplicate_item", "1")], "supplier long, rule string, row_key string")
    got = match.match(*gates.accepted_run(offers, catalog, bad)).collect()
    assert {(r["supplier"], r["status"]) for r in got} == {(1, "exact")} and len(got) == 3
    twice = match.match(offers, catalog.union(catalog), repeated_products=True)
    assert {r["matched_by"] for r in twice.collect()} == {"sku"} and {r["status"] for r in twice.collect()} == {"ambiguous"}


def test_gaps_are_those_of_the_streaks(spark):
    seen = spark.createDataFrame([(1, p, r) for p in range(6) for r in range(20) if (p * 7 + r * r) % 5 == 0 or p == 5 and r == 6], "supplier long, product_id long, run long")
    runs = spark.range(20).where("id % 7 <> 6").select(F.col("id").alias("run"), (F.col("id") + 1 - F.floor((F.col("id") + 1) / 7)).cast("int").alias("place"))
    presence = seen.select("supplier", "product_id").distinct().join(spark.range(20).withColumnRenamed("id", "run")).join(seen.withColumn("there", F.lit(True)), ["supplier", "product_id", "run"], "left").select("supplier", "product_id", "run", F.col("there").isNull().alias("missing"), (F.col("run") % 7 != 6).alias("complete"))
    n = F.col("consecutive_missing_runs")
    want = missing.streaks(presence).groupBy("supplier", "product_id").agg(F.max(n).alias("longest"), F.max_by(n, "run").alias("present"), F.count("*").alias("n_runs"))
    assert {tuple(r) for r in missing.gaps(seen, runs).collect()} == {tuple(r) for r in want.collect()}


def test_no_machine_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://h:7077"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, other=None: None)})()

    with pytest.raises(ValueError):
        store.shared_folder(Session())


def test_parity_and_manifest(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "z")], "position int, id string")
    b = spark.createDataFrame([(1, "x"), (2, "w"), (3, None), (5, "z")], "position int, id string")
    assert {tuple(r) for r in audit.parity(a, b).collect()} == {(2, "differs"), (4, "only_first"), (5, "only_second")}


def test_feed_files_are_bounded(spark, sf, monkeypatch):
    monkeypatch.setattr(landing, "OFFERS_A_FILE", 300)
    rows = spark.range(0, 2000, 1, 2).selectExpr("id AS _id", "concat('n', id) AS name")
    folder = landing._files(rows, "bounded")
    files = [p.read_text() for p in Path(folder).glob("part-*")]
    counts = [t.count("<offer ") for t in files]
    assert sum(counts) == 2000 and max(counts) <= 300


def test_batch_status_reads_the_offers_of_its_run(spark, sf):
    """The offers are made once, not again for the suppliers and their rejects."""
    assert not [f for f in landing.QUERIES["batch_status_broken"](spark, sf).inputFiles() if "lineitem" in f]
