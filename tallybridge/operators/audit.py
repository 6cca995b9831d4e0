"""Digests, seals, ledgers and checks over stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybridge.functions.canonical import canonical_row
from tallybridge.functions.store import stored


#: Distinct rows that a bucket of a digest is to hold in the mean, and hex digits folded at once.
DIGEST_ROWS, DIGEST_FOLD = 1024, 3


def digest_width(n_distinct: int) -> int:
    """Hex digits of a row hash that name its bucket, for so many distinct rows."""
    width = 0
    while 16**width * DIGEST_ROWS < n_distinct:
        width += 1
    return width


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(n_rows, digest): the same for any order of the rows, another if a row repeats or differs.

    Rows are hashed and equal hashes counted; ``hash:count`` lines are sorted and hashed within
    buckets of the hash's first digits, and the buckets' lines again until one is left.  Buckets
    follow the number of distinct rows, so what a task sorts is bounded; a row that repeats
    often is one line.
    """
    counted = df.select(F.sha2(canonical_row(df, columns), 256).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    counted = stored(counted, "digest")
    n_distinct, n_rows = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    width = digest_width(n_distinct)
    lines = counted.select(F.substring("h", 1, width).alias("b"), F.concat_ws(":", "h", "n").alias("line"))
    while True:
        folded = lines.groupBy("b").agg(F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("line"))), 256).alias("d"))
        if width == 0:
            break
        width = max(0, width - DIGEST_FOLD)
        lines = folded.select(F.substring("b", 1, width).alias("b"), F.concat_ws(":", "b", "d").alias("line"))
    one = df.sparkSession.createDataFrame([(n_rows,)], "n_rows long")
    return one.join(folded.select(F.col("d").alias("digest")), F.lit(True), "left").withColumn("digest", F.coalesce("digest", F.sha2(F.lit(""), 256)))


def parity(first: DataFrame, second: DataFrame) -> DataFrame:
    """(position, status) of two lists (position, id) where they do not agree."""
    both = first.select("position", F.col("id").alias("a"), F.lit(True).alias("in_a")).join(second.select("position", F.col("id").alias("b"), F.lit(True).alias("in_b")), "position", "full")
    status = F.when(F.col("in_b").isNull(), "only_first").when(F.col("in_a").isNull(), "only_second").when(~F.col("a").eqNullSafe(F.col("b")), "differs")
    return both.select("position", status.alias("status")).where("status is not null")


def shared_skus(offers: DataFrame, catalog: DataFrame) -> DataFrame:
    """(supplier, n): SKUs of the catalogue that the supplier's feed generates."""
    ours = offers.select("supplier", F.col("catalog_sku").alias("sku"))
    return catalog.select("supplier", "sku").distinct().join(ours, ["supplier", "sku"], "left_semi").groupBy("supplier").agg(F.count("*").alias("n"))


def manifest_inputs(manifest: DataFrame, bundle: DataFrame, external: DataFrame) -> DataFrame:
    """(path, status) of the inputs that a manifest records, against the files of its bundle and the
    files they were copied from; all (path, sha256, size)."""
    side = lambda df, n: df.select("path", F.col("sha256").alias(f"{n}_sha256"), F.col("size").alias(f"{n}_size"), F.lit(True).alias(f"in_{n}"))
    rows = manifest.join(side(bundle, "bundle"), "path", "left").join(side(external, "external"), "path", "left")
    same = lambda n: F.col("sha256").eqNullSafe(F.col(f"{n}_sha256")) & F.col("size").eqNullSafe(F.col(f"{n}_size"))
    status = F.when(F.col("in_bundle").isNull(), "not_in_bundle").when(~same("bundle"), "bundle_differs").when(F.col("in_external").isNull(), "no_external_file").when(~same("external"), "external_differs").otherwise("ok")
    return rows.select("path", status.alias("status"))


def seal_diff(seal: DataFrame, present: DataFrame) -> DataFrame:
    """(path, status) of two listings (path, sha256, size): unchanged, missing, extra, changed."""
    a, b = seal.alias("a"), present.alias("b")
    rows = a.join(b, F.col("a.path") == F.col("b.path"), "full")
    same = F.col("a.sha256").eqNullSafe(F.col("b.sha256")) & F.col("a.size").eqNullSafe(F.col("b.size"))
    status = F.when(F.col("b.path").isNull(), "missing").when(F.col("a.path").isNull(), "extra").when(same, "unchanged").otherwise("changed")
    return rows.select(F.coalesce("a.path", "b.path").alias("path"), status.alias("status"))


def ledger_append(ledger: DataFrame, landed: DataFrame, contract: list[str]) -> tuple[DataFrame, DataFrame]:
    """(new rows, conflicts): content that is not in the ledger yet, once; and content that is,
    with other contract columns."""
    key = ["supplier", "content_sha256"]
    first = Window.partitionBy(*key).orderBy("feed_date", *contract, *[c for c in landed.columns if c not in (*key, "feed_date", *contract)])
    once = landed.withColumn("turn", F.row_number().over(first)).where("turn = 1").drop("turn")
    new = once.join(ledger.select(*key), key, "left_anti")
    pairs = landed.alias("n").join(ledger.alias("o"), key)
    differs = reduce(lambda x, c: x | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")), contract, F.lit(False))
    return new, pairs.where(differs).select(*key).distinct()


def latest_snapshot(ledger: DataFrame) -> DataFrame:
    """The newest accepted snapshot of each supplier."""
    return ledger.where("accepted").groupBy("supplier").agg(F.max_by(F.struct("content_sha256", "feed_date"), F.struct("feed_date", "content_sha256")).alias("s")).select("supplier", "s.content_sha256", "s.feed_date")


def promote_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the new state that may replace the current one: suppliers whose run passed."""
    return state.join(batch.where("status = 'PASS'").select("supplier"), "supplier", "left_semi")


def approval_rows(batch: DataFrame) -> DataFrame:
    """Pending approvals with what stands against them."""
    blockers = F.array_compact(F.array(F.when(~F.coalesce("read_only", F.lit(False)), "run_not_read_only"), F.when(~F.coalesce("feed_complete", F.lit(False)), "feed_incomplete")))
    return batch.withColumn("blockers", blockers).withColumn("eligible", F.size("blockers") == 0).withColumn("approval", F.lit("pending"))


def check(rows: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    """One row (supplier, name, passed, detail) per supplier of an aggregate."""
    return rows.select("supplier", F.lit(name).alias("name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.cast("string").alias("detail"))


def verify(offers: DataFrame, matches: DataFrame, proposals: DataFrame, mapped: DataFrame) -> DataFrame:
    """The checks of a run, a row for each supplier and check."""
    n_offers = offers.groupBy("supplier").agg(F.count("*").alias("n_offers"), F.countDistinct("supplier_item_id").alias("d_offers"))
    n_matches = matches.groupBy("supplier").agg(
        F.count("*").alias("n_matches"),
        F.countDistinct("supplier_item_id").alias("d_matches"),
        F.count("catalog_product_id").alias("n_claims"),
        F.countDistinct("catalog_product_id").alias("d_claims"),
        F.count_if((F.col("status") == "unmatched") & F.col("catalog_product_id").isNotNull()).alias("bad_unmatched"),
        F.count_if((F.col("status") == "conflict") & (F.size("warnings") == 0)).alias("bare_conflicts"),
    )
    blocked = F.col("proposed_price").isNotNull() & ~F.col("status").isin("ready_for_review", "blocked_delta", "blocked_current_price")
    n_proposals = proposals.groupBy("supplier").agg(F.count("*").alias("n_proposals"), F.count_if(blocked).alias("priced_blocked"), F.min("proposed_price").alias("least"), F.count_if((F.col("status") == "ready_for_review") & ~F.col("currency").isin("RUB", "RUR")).alias("foreign"))
    published = mapped.groupBy("supplier").agg(F.count_if("publication_eligible").alias("published"))
    all_ = n_offers.join(n_matches, "supplier", "left").join(n_proposals, "supplier", "left").join(published, "supplier", "left")
    c = F.col
    rules = [
        ("offer_ids_unique", c("n_offers") == c("d_offers"), c("d_offers")),
        ("a_match_per_offer", (c("n_offers") == c("n_matches")) & (c("n_matches") == c("d_matches")), c("n_matches")),
        ("products_claimed_once", c("n_claims") == c("d_claims"), c("n_claims")),
        ("unmatched_have_no_product", c("bad_unmatched") == 0, c("bad_unmatched")),
        ("conflicts_say_why", c("bare_conflicts") == 0, c("bare_conflicts")),
        ("a_proposal_per_offer", c("n_offers") == c("n_proposals"), c("n_proposals")),
        ("no_price_when_blocked", c("priced_blocked") == 0, c("priced_blocked")),
        ("prices_positive", F.coalesce(c("least") > 0, F.lit(True)), F.lit("")),
        ("approved_currency_only", c("foreign") == 0, c("foreign")),
        ("categories_not_published", c("published") == 0, c("published")),
    ]
    # One pass: the aggregate row is unfolded into its checks.
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(p, F.lit(False)).alias("passed"), d.cast("string").alias("detail")) for n, p, d in rules])
    return all_.select("supplier", F.inline(cells))


def source_audits(offers: DataFrame, proposals: DataFrame, currencies: tuple[str, ...] = ("RUR",)) -> DataFrame:
    """(supplier, name, passed, detail) of a run that may calculate no price: every source price above 0, no currency but the
    known ones, and no proposal with a price (a supplier without proposals has none)."""
    source = offers.groupBy("supplier").agg(F.min("source_price").alias("least"), F.array_sort(F.collect_set("currency")).alias("currencies"))
    priced = proposals.groupBy("supplier").agg(F.bool_and(F.col("proposed_price").isNull()).alias("none"), F.count("proposed_price").alias("n_priced"))
    known = F.size(F.array_except("currencies", F.array(*[F.lit(c) for c in currencies]))) == 0
    rules = [
        ("source_prices_positive", F.col("least") > 0, F.col("least").cast("string")),
        ("source_currency_known", known, F.array_join("currencies", ",")),
        ("no_calculated_prices", F.coalesce("none", F.lit(True)), F.coalesce("n_priced", F.lit(0)).cast("string")),
    ]
    cells = F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(p, F.lit(False)).alias("passed"), d.alias("detail")) for n, p, d in rules])
    return source.join(priced, "supplier", "left").select("supplier", F.inline(cells))


def roll_up(checks: DataFrame) -> DataFrame:
    return checks.groupBy("supplier").agg(F.when(F.bool_and("passed"), "PASS").otherwise("FAIL").alias("status"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"))
