"""One case for each branch of the identity match, the price gate, the state and the rejects."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybridge.functions.text import identity_key
from tallybridge.operators import audit, categories, match, missing, pricing, rejects
from tallybridge.plans import catalogue
from tallybridge.sources import views

OFFER = "supplier long, supplier_item_id string, feed_pos long, catalog_sku string, manufacturer string, mpn string, model string, ean string, identity_warnings array<string>"
PRODUCT = "supplier long, product_id long, sku string, model string, ean string, manufacturer string"


def offer(i, sku="11-x", brand=None, mpn=None, ean=None, warn=(), model=None):
    return (1, str(i), i, sku, brand, mpn, model, ean, list(warn))


def run(spark, offers, products):
    m = match.match(spark.createDataFrame(offers, OFFER), spark.createDataFrame(products, PRODUCT))
    return {r["supplier_item_id"]: (r["status"], r["matched_by"], r["catalog_product_id"], float(r["confidence"]), list(r["warnings"])) for r in m.collect()}


@pytest.mark.parametrize(
    "offers, products, want",
    [
        ([offer(1, "s", "Acme", "M-1", "46")], [(1, 7, "s", "m1", "46", "ACME")], ("exact", "sku", 7, 1.0, [])),
        ([offer(1, "s", ean="46")], [(1, 7, "s", "", "47", "")], ("conflict", "sku", 7, 0.5, ["ean_mismatch"])),
        ([offer(1, "s", "Acme", "M-1", "46")], [(1, 7, "s", "m2", "47", "B")], ("conflict", "sku", 7, 0.5, ["ean_mismatch", "model_mismatch", "manufacturer_mismatch"])),
        ([offer(1, "s")], [(1, 7, "s", "", "", ""), (1, 8, "s", "", "", "")], ("ambiguous", "sku", None, 0, ["catalog_sku_not_unique"])),
        ([offer(1, "s", ean=" 46 ")], [(1, 7, "t", "", "46", "")], ("high_confidence", "ean_unique", 7, 0.95, [])),
        ([offer(1, "s", ean="46"), offer(2, "u", ean="46")], [(1, 7, "t", "", "46", "")], ("ambiguous", "identity_candidate", None, 0, ["ean_not_unique"])),
        ([offer(1, "s", ean="46")], [(1, 7, "t", "", "46", ""), (1, 8, "v", "", "46", "")], ("ambiguous", "identity_candidate", None, 0, ["ean_not_unique"])),
        ([offer(1, "s", "Acme", "M 1")], [(1, 7, "t", "m-1", "", "ACME")], ("high_confidence", "manufacturer_model_unique", 7, 0.9, [])),
        ([offer(1, "s", "Acme", "", model="M 1")], [(1, 7, "t", "m-1", "", "ACME")], ("high_confidence", "manufacturer_model_unique", 7, 0.9, [])),
        ([offer(1, "s", "Acme", "M 1", "46")], [(1, 7, "t", "m-1", "47", "ACME")], ("conflict", "manufacturer_model_unique", 7, 0.5, ["ean_mismatch"])),
        ([offer(1, "s", "Acme", "M 1"), offer(2, "u", "acme", "m1")], [(1, 7, "t", "m-1", "", "ACME")], ("ambiguous", "identity_candidate", None, 0, ["manufacturer_model_not_unique"])),
        ([offer(1, "s", warn=["ambiguous_ean", "ambiguous_ean"])], [(1, 7, "s", "", "", "")], ("ambiguous", "identity_conflict", None, 0, ["ambiguous_ean"])),
        ([offer(1, "s")], [(1, 7, "t", "", "", "")], ("unmatched", None, None, 0, [])),
        ([offer(1, "s", "Ё", "1")], [(1, 7, "t", "1", "", "Ё")], ("unmatched", None, None, 0, [])),
    ],
)
def test_branch(spark, offers, products, want):
    assert run(spark, offers, products)["1"] == want


def test_first_in_feed_order_claims_a_product(spark):
    got = run(spark, [offer(2, "s"), offer(1, "u", ean="46")], [(1, 7, "s", "", "46", "")])
    assert got["1"][:3] == ("high_confidence", "ean_unique", 7)
    assert got["2"] == ("ambiguous", "catalog_product_reused", None, 0, ["catalog_product_reused"])


def test_suppliers_do_not_meet_and_order_of_rows_does_not_matter(spark):
    rows = [offer(i, f"s{i}", "Acme", f"M{i}", f"46{i % 3}") for i in range(20)]
    products = [(1, i, f"s{i + 10}", f"m{i}", f"46{i}", "acme") for i in range(15)]
    one = run(spark, rows, products)
    assert one == run(spark, rows[::-1], products[::-1])
    other = [(2, *r[1:]) for r in rows]
    both = match.match(spark.createDataFrame(rows + other, OFFER), spark.createDataFrame(products, PRODUCT))
    assert {r["status"] for r in both.where("supplier = 2").collect()} == {"unmatched"}


def test_missing_products(spark):
    offers, products = spark.createDataFrame([offer(1, "s")], OFFER), spark.createDataFrame([(1, 7, "s", "", "", ""), (1, 8, "t", "", "", "")], PRODUCT)
    got = match.catalog_missing(products, match.match(offers, products)).collect()
    assert [(r["product_id"], r["sku"]) for r in got] == [(8, "t")]


def price(spark, source="100.55", currency="RUR", current="110.00", status="exact", product=7, vat="included", rule="r", approved=True, multiplier="1.10", rate="1", most="25"):
    d = lambda v: None if v is None else Decimal(v)
    offers = spark.createDataFrame([(1, "1", d(source), currency)], "supplier long, supplier_item_id string, source_price decimal(20,4), currency string")
    matches = spark.createDataFrame([(1, "1", product, status)], "supplier long, supplier_item_id string, catalog_product_id long, status string")
    catalog = spark.createDataFrame([(1, 7, d(current))], "supplier long, product_id long, current_price decimal(20,4)")
    policy = spark.createDataFrame([(1, vat, rule, "2", approved, d(multiplier), d(most))], "supplier long, vat_basis string, rule_id string, rule_version string, approved boolean, multiplier decimal(9,4), max_delta_pct decimal(9,2)")
    rates = spark.createDataFrame([(1, "RUR", d(rate))] if rate else [], "supplier long, currency string, rub_per_unit decimal(18,8)")
    r = pricing.propose(offers, matches, catalog, policy, rates).first()
    return r["status"], r["warning"], r["proposed_price"]


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, ("ready_for_review", None, Decimal("110.605"))),
        ({"status": "conflict"}, ("blocked_match", "match_not_exact", None)),
        ({"product": None}, ("blocked_match", "match_not_exact", None)),
        ({"source": "0"}, ("blocked_source_price", "nonpositive_source_price", None)),
        ({"currency": "USD"}, ("blocked_currency", "currency_not_approved", None)),
        ({"rate": None}, ("blocked_currency", "missing_or_invalid_exchange_rate", None)),
        ({"rate": "2"}, ("blocked_currency", "currency_parity_not_approved", None)),
        ({"vat": "unknown"}, ("blocked_vat_basis", "vat_basis_unknown", None)),
        ({"rule": None}, ("blocked_missing_markup", "markup_policy_not_approved", None)),
        ({"approved": False}, ("blocked_missing_markup", "markup_policy_not_approved", None)),
        ({"multiplier": "0"}, ("blocked_markup", "invalid_markup_rule", None)),
        ({"current": "0"}, ("blocked_current_price", "nonpositive_current_price", Decimal("110.605"))),
        ({"source": "125.0001", "current": "110"}, ("blocked_delta", "delta_exceeds_limit", Decimal("137.50011"))),
        ({"source": "125", "current": "110"}, ("ready_for_review", None, Decimal("137.5"))),
    ],
)
def test_price_rule(spark, change, want):
    assert price(spark, **change) == want


def test_state_counts_only_complete_runs(spark):
    state = spark.createDataFrame([(1, 7, "a", 2, None, 1), (1, 8, "b", 2, None, 1), (2, 9, "c", 1, None, 1)], missing.STATE)
    gone = spark.createDataFrame([(1, 7, "a2"), (1, 5, "n"), (2, 9, "c")], "supplier long, product_id long, sku string")
    runs = spark.createDataFrame([(1, 4, True), (2, 4, False)], "supplier long, run long, complete boolean")
    new = missing.step(state, gone, runs)
    got = {r["product_id"]: (r["sku"], r["consecutive_missing_runs"], r["last_seen_run"], r["last_missing_run"]) for r in new.collect()}
    assert got == {7: ("a2", 3, None, 4), 8: ("b", 0, 4, 1), 5: ("n", 1, None, 4), 9: ("c", 1, None, 1)}
    policy = spark.createDataFrame([(1, "hide", 3), (2, "hide", 1)], "supplier long, action string, threshold int")
    assert [(r["product_id"], r["sku"]) for r in missing.actions(new, runs, policy).collect()] == [(7, "a2")]


def test_steps_agree_with_streaks(spark):
    rows = [(1, p, r, (p * 7 + r * r) % 3 > 0, r % 4 != 3) for p in range(12) for r in range(9)]
    presence = spark.createDataFrame(rows, "supplier long, product_id long, run long, missing boolean, complete boolean")
    state = spark.createDataFrame([], missing.STATE)
    for r in range(9):
        one = presence.where(F.col("run") == r)
        state = missing.step(state, one.where("missing").select("supplier", "product_id", F.lit("s").alias("sku")), one.select("supplier", "run", "complete").distinct())
    stepped = {r["product_id"]: r["consecutive_missing_runs"] for r in state.collect()}
    last = missing.streaks(presence).where("run = 8").collect()
    assert {r["product_id"]: r["consecutive_missing_runs"] for r in last} == {p: stepped.get(p, 0) for p in range(12)}


def test_category_paths_and_cycles(spark):
    cats = spark.createDataFrame([("1", "a", None), ("2", "b", "1"), ("3", "c", "2"), ("4", "x", "5"), ("5", "y", "4"), ("6", "z", "9")], "id string, name string, parent_id string")
    got = {r["id"]: (list(r["path"]), r["broken"]) for r in categories.paths(cats).collect()}
    assert got["3"] == (["a", "b", "c"], None) and got["1"] == (["a"], None)
    assert got["4"][1] == got["5"][1] == "cycle" and got["6"][1] == "unknown_parent"


def test_category_status(spark):
    cases = {"strong": ["A"] * 3, "review": ["A"] * 4 + ["B"], "ambiguous": ["A", "B"], "one": ["A"], "none": []}
    offers, matches, catalog, i = [], [], [], 0
    for path, targets in cases.items():
        for t in [*targets, None]:
            i += 1
            offers.append((1, str(i), [path], i))
            matches.append((1, str(i), "exact" if t else "unmatched", i if t else None))
            if t:
                catalog.append((1, i, t, t.lower()))
    o = spark.createDataFrame(offers, "supplier long, supplier_item_id string, category_path array<string>, feed_pos long")
    m = spark.createDataFrame(matches, "supplier long, supplier_item_id string, status string, catalog_product_id long")
    c = spark.createDataFrame(catalog, "supplier long, product_id long, category_ids string, categories string")
    got = {r["category_path"][0]: (r["mapping_status"], r["suggested_category_ids"], r["source_only_products"]) for r in categories.mapping(o, m, c).collect()}
    assert got == {"strong": ("strong_candidate", "A", 1), "review": ("review_candidate", "A", 1), "ambiguous": ("ambiguous", "A", 1), "one": ("ambiguous", "A", 1), "none": ("unmapped", "", 1)}


def test_reject_rules_block_only_their_supplier(spark):
    rows = spark.createDataFrame([(1, "5", "a", "1.5", "2", "1"), (1, "x", "", "-1", "1.5", ""), (2, "6", "b", "", "0", "0"), (3, "0", "c", "NaN", "-2", "z")], "supplier long, product_id string, sku string, price string, quantity string, status string")
    bad = rejects.catalog_rows(rows)
    assert sorted((r["supplier"], r["rule"]) for r in bad.collect()) == [(1, "price"), (1, "product_id"), (1, "quantity"), (1, "sku"), (1, "status"), (3, "price"), (3, "product_id"), (3, "quantity"), (3, "status")]
    assert [r["supplier"] for r in rejects.accepted(rows, bad).collect()] == [2]
    checks = spark.createDataFrame([(2, False), (4, True)], "supplier long, passed boolean")
    batch = rejects.batch_status(spark.createDataFrame([(s,) for s in (1, 2, 3, 4)], "supplier long"), bad, checks)
    assert {r["supplier"]: r["status"] for r in batch.collect()} == {1: "BLOCKED", 2: "FAIL", 3: "BLOCKED", 4: "PASS"}
    assert tuple(rejects.exit_status(batch).first()) == (1, 2, 1, 2)


def test_seal_and_ledger(spark):
    kind = "path string, sha256 string, size long"
    got = audit.seal_diff(spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("c", "1", 1)], kind), spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("d", "1", 1)], kind))
    assert {r["path"]: r["status"] for r in got.collect()} == {"a": "unchanged", "b": "changed", "c": "missing", "d": "extra"}
    kind = "supplier long, content_sha256 string, feed_date string, contract string"
    new, clash = audit.ledger_append(spark.createDataFrame([(1, "a", "d", "x")], kind), spark.createDataFrame([(1, "a", "d", "x"), (1, "b", "d", "x"), (1, "b", "d", "x"), (2, "a", "d", "x")], kind), ["contract"])
    assert sorted((r["supplier"], r["content_sha256"]) for r in new.collect()) == [(1, "b"), (2, "a")] and clash.count() == 0
    _, clash = audit.ledger_append(spark.createDataFrame([(1, "a", "d", "x")], kind), spark.createDataFrame([(1, "a", "d", "y")], kind), ["contract"])
    assert clash.count() == 1


def test_identity_key_is_what_the_pattern_leaves(spark):
    texts = [None, "", "  ", "ab-12", "Ёж №7 \U0001f600x\U0001f600", "ßtraße", "а.Б/я", "a\u0000b", "--", "ÀÉ1", "\ud7ff!9", "\u0410\u042f\u0430\u044f\u0451"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace(F.upper(F.coalesce("t", F.lit(""))), "[^0-9A-ZА-Я]+", "")
    assert rows.where(identity_key(F.col("t")) != plain).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_suppliers_are_dealt_once_and_match_the_same(spark, sf):
    run = catalogue._Run(spark, sf)
    assert match.small_suppliers(run.offers, run.catalog)
    once, by_key = match.match(run.offers, run.catalog, by_supplier=True), match.match(run.offers, run.catalog)
    assert _plan(once).count("Exchange hashpartitioning") == 1 and "Join" not in _plan(once)
    assert _plan(by_key).count("Exchange hashpartitioning") == 4
    assert once.exceptAll(by_key).isEmpty() and by_key.exceptAll(once).isEmpty() and once.count() == run.offers.count()


def test_carried_columns_are_those_of_the_joins(spark, sf):
    run = catalogue._Run(spark, sf, catalogue._PRICES, catalogue._CATEGORIES)
    joined = pricing.propose(run.offers, run.matches, run.catalog, *catalogue._policy(run.offers))
    assert joined.exceptAll(run.proposals()).isEmpty() and run.proposals().exceptAll(joined).isEmpty()
    mapped = categories.mapping(run.offers, run.matches, run.catalog)
    assert mapped.exceptAll(run.mapped()).isEmpty() and run.mapped().exceptAll(mapped).isEmpty()
    products = categories.product_proposals(run.offers, run.matches, run.mapped())
    assert products.exceptAll(run.products()).isEmpty() and run.products().exceptAll(products).isEmpty()


def test_offers_and_catalogue_come_from_one_pass_over_the_lines(spark, sf):
    pairs = views.pairs(spark, sf)
    plan = _plan(pairs)
    # Dealt by part once: neither the grouping nor the join deals the lines again, and no size of part makes it a merge join.
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2 and "ShuffledHashJoin" in plan
    for one, other in ((views.offers(spark, sf), views.offers_from(pairs)), (views.catalog(spark, sf), views.catalog_from(pairs))):
        assert one.schema == other.schema and one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_a_run_deals_its_rows_before_it_makes_their_columns(spark, sf):
    run = catalogue._Run(spark, sf, catalogue._PRICES, catalogue._CATEGORIES)
    plan = _plan(run.matched())
    # One deal for each side, below the union; the windows take the rows as they lie.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.index("Union") < plan.index("Exchange hashpartitioning")
    plain = match.match(run.offers, run.catalog)
    mine = run.matches.select(plain.columns)
    assert mine.exceptAll(plain).isEmpty() and plain.exceptAll(mine).isEmpty()
    assert match.supplier_rows(run.offers, run.catalog)[1] == run.offers.count() + run.catalog.count()
    cores = spark.sparkContext.defaultParallelism
    assert match.tasks_for(10, spark) == cores and match.tasks_for(1_000 * match.TASK_ROWS + 1, spark) == 1_001


def test_the_summary_of_categories_maps_them_once(spark, sf, monkeypatch):
    made, plain = [], categories.map_rows
    monkeypatch.setattr(categories, "map_rows", lambda rows: made.append(1) or plain(rows))
    assert catalogue.category_summary(spark, sf).count() > 0 and len(made) == 1
