"""The same queries in SQL, for the comparison with another engine."""

from __future__ import annotations

from tallybridge.sources.views import CATALOG_SQL, CATEGORIES_SQL, OFFERS_SQL, SEEN_SQL


def _identity(x: str) -> str:
    return f"regexp_replace(upper(coalesce({x}, '')), '[^0-9A-ZА-Я]+', '', 'g')"


def _pair(brand: str, model: str) -> str:
    a, b = _identity(brand), _identity(model)
    return f"CASE WHEN {a} <> '' AND {b} <> '' THEN {a} || '|' || {b} END"


BASE = f"""WITH offers AS ({OFFERS_SQL}), catalog AS ({CATALOG_SQL})"""

MATCH = f"""{BASE},
o AS (SELECT *, nullif(trim(ean), '') AS ke, {_pair("manufacturer", "coalesce(nullif(mpn, ''), model)")} AS kb FROM offers),
c AS (SELECT *, nullif(trim(ean), '') AS ke, {_pair("manufacturer", "model")} AS kb FROM catalog),
cs AS (SELECT supplier, sku, count(*) AS n, min(product_id) AS pid FROM c GROUP BY supplier, sku),
ce AS (SELECT supplier, ke, count(*) AS n, min(product_id) AS pid FROM c WHERE ke IS NOT NULL GROUP BY supplier, ke),
cb AS (SELECT supplier, kb, count(*) AS n, min(product_id) AS pid FROM c WHERE kb IS NOT NULL GROUP BY supplier, kb),
oe AS (SELECT supplier, ke, count(*) AS n FROM o WHERE ke IS NOT NULL GROUP BY supplier, ke),
ob AS (SELECT supplier, kb, count(*) AS n FROM o WHERE kb IS NOT NULL GROUP BY supplier, kb),
w AS (SELECT o.*, CASE WHEN identity_warning IS NOT NULL THEN 'identity_conflict' WHEN cs.n = 1 THEN 'sku' WHEN cs.n > 1 THEN 'catalog_sku_not_unique'
    WHEN ce.n = 1 AND oe.n = 1 THEN 'ean_unique' WHEN ce.n >= 1 THEN 'ean_not_unique'
    WHEN cb.n = 1 AND ob.n = 1 THEN 'manufacturer_model_unique' WHEN cb.n >= 1 THEN 'manufacturer_model_not_unique' END AS way,
    cs.pid AS ps, ce.pid AS pe, cb.pid AS pb
  FROM o LEFT JOIN cs ON cs.supplier = o.supplier AND cs.sku = o.catalog_sku
  LEFT JOIN ce ON ce.supplier = o.supplier AND ce.ke = o.ke LEFT JOIN oe ON oe.supplier = o.supplier AND oe.ke = o.ke
  LEFT JOIN cb ON cb.supplier = o.supplier AND cb.kb = o.kb LEFT JOIN ob ON ob.supplier = o.supplier AND ob.kb = o.kb),
x AS (SELECT *, CASE way WHEN 'sku' THEN ps WHEN 'ean_unique' THEN pe WHEN 'manufacturer_model_unique' THEN pb END AS pid FROM w),
t AS (SELECT x.*, row_number() OVER (PARTITION BY x.supplier, x.pid ORDER BY x.feed_pos) AS turn,
    coalesce(x.ean, '') <> '' AND coalesce(c.ean, '') <> '' AND x.ean <> c.ean AS bad_ean,
    coalesce(x.mpn, '') <> '' AND coalesce(c.model, '') <> '' AND {_identity("x.mpn")} <> {_identity("c.model")} AS bad_model,
    coalesce(x.manufacturer, '') <> '' AND coalesce(c.manufacturer, '') <> '' AND {_identity("x.manufacturer")} <> {_identity("c.manufacturer")} AS bad_brand
  FROM x LEFT JOIN c ON c.supplier = x.supplier AND c.product_id = x.pid),
u AS (SELECT *, pid IS NOT NULL AND turn = 1 AS claimed, pid IS NOT NULL AND turn > 1 AS reused,
    concat_ws(',', CASE WHEN bad_ean THEN 'ean_mismatch' END, CASE WHEN bad_model THEN 'model_mismatch' END, CASE WHEN bad_brand THEN 'manufacturer_mismatch' END) AS mism FROM t),
v AS (SELECT *, (way = 'sku' AND mism <> '') OR (way = 'manufacturer_model_unique' AND bad_ean) AS clash FROM u),
matches AS (SELECT supplier, supplier_item_id, feed_pos, catalog_sku, CASE WHEN claimed THEN pid END AS catalog_product_id,
    CASE WHEN way IS NULL THEN 'unmatched' WHEN NOT claimed THEN 'ambiguous' WHEN clash THEN 'conflict' WHEN way = 'sku' THEN 'exact' ELSE 'high_confidence' END AS status,
    CASE WHEN claimed AND clash THEN 50 WHEN claimed AND way = 'sku' THEN 100 WHEN claimed AND way = 'ean_unique' THEN 95 WHEN claimed THEN 90 ELSE 0 END AS confidence_pct,
    CASE WHEN reused THEN 'catalog_product_reused' WHEN way = 'catalog_sku_not_unique' THEN 'sku' WHEN way IN ('ean_not_unique', 'manufacturer_model_not_unique') THEN 'identity_candidate' ELSE way END AS matched_by,
    CASE WHEN way IS NULL THEN '' WHEN way = 'identity_conflict' THEN identity_warning WHEN reused THEN 'catalog_product_reused' WHEN claimed THEN mism ELSE way END AS warnings
  FROM v)"""

MISSING = f"""{MATCH}, missing AS (SELECT c.supplier, c.product_id, c.sku FROM catalog c
  WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.supplier = c.supplier AND m.catalog_product_id = c.product_id))"""

PRICES = f"""{MATCH}, j AS (SELECT m.supplier, m.supplier_item_id, m.status AS ms, m.catalog_product_id AS pid, o.price_cents, o.currency, coalesce(k.price_cents, 0) AS cur,
    m.supplier % 10 AS pol, o.available, k.quantity
  FROM matches m JOIN offers o ON o.supplier = m.supplier AND o.supplier_item_id = m.supplier_item_id
  LEFT JOIN catalog k ON k.supplier = m.supplier AND k.product_id = m.catalog_product_id),
b AS (SELECT *, CASE WHEN ms <> 'exact' OR pid IS NULL THEN 0 WHEN price_cents <= 0 THEN 1 WHEN currency NOT IN ('RUB', 'RUR') THEN 2
    WHEN pol = 6 THEN 4 WHEN pol = 7 THEN 5 WHEN pol = 8 THEN 6 WHEN pol = 9 THEN 7 END AS block FROM j),
d AS (SELECT *, CASE WHEN block IS NULL THEN price_cents * 110 END AS proposed_e4, CASE WHEN block IS NULL THEN price_cents * 110 - cur * 100 END AS delta_e4 FROM b),
proposals AS (SELECT supplier, supplier_item_id, pid AS catalog_product_id, proposed_e4, delta_e4,
  CASE WHEN block = 0 THEN 'blocked_match' WHEN block = 1 THEN 'blocked_source_price' WHEN block IN (2, 4) THEN 'blocked_currency' WHEN block = 5 THEN 'blocked_vat_basis'
    WHEN block = 6 THEN 'blocked_missing_markup' WHEN block = 7 THEN 'blocked_markup' WHEN cur <= 0 THEN 'blocked_current_price' WHEN abs(delta_e4) * 100 > 25 * cur * 100 THEN 'blocked_delta' ELSE 'ready_for_review' END AS status,
  CASE WHEN block = 0 THEN 'match_not_exact' WHEN block = 1 THEN 'nonpositive_source_price' WHEN block = 2 THEN 'currency_not_approved' WHEN block = 4 THEN 'currency_parity_not_approved' WHEN block = 5 THEN 'vat_basis_unknown'
    WHEN block = 6 THEN 'markup_policy_not_approved' WHEN block = 7 THEN 'invalid_markup_rule' WHEN cur <= 0 THEN 'nonpositive_current_price' WHEN abs(delta_e4) * 100 > 25 * cur * 100 THEN 'delta_exceeds_limit' END AS warning,
  ms, currency, price_cents, cur, available, quantity FROM d)"""

CATEGORY = f"""{MATCH}, rows_ AS (SELECT o.supplier, o.category_1, o.category_2, o.feed_pos, m.status, m.catalog_product_id FROM offers o JOIN matches m ON m.supplier = o.supplier AND m.supplier_item_id = o.supplier_item_id),
tot AS (SELECT supplier, category_1, category_2, count(*) AS source_total, count(*) FILTER (status = 'unmatched') AS source_only_products FROM rows_ GROUP BY ALL),
tgt AS (SELECT r.supplier, r.category_1, r.category_2, k.category_ids, k.categories, count(*) AS support, min(r.feed_pos) AS fp FROM rows_ r JOIN catalog k ON k.supplier = r.supplier AND k.product_id = r.catalog_product_id WHERE r.status = 'exact' GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY supplier, category_1, category_2 ORDER BY support DESC, fp) AS rn, sum(support) OVER (PARTITION BY supplier, category_1, category_2) AS tsup, count(*) OVER (PARTITION BY supplier, category_1, category_2) AS n_alt FROM tgt),
mapping AS (SELECT tot.*, CAST(coalesce(tsup, 0) AS BIGINT) AS exact_support, coalesce(category_ids, '') AS suggested_category_ids, coalesce(categories, '') AS suggested_categories, coalesce(support, 0) AS dominant_support, coalesce(n_alt, 0) AS n_alternatives,
    CASE WHEN tsup >= 3 AND support = tsup THEN 'strong_candidate' WHEN tsup >= 2 AND support * 10 >= tsup * 8 THEN 'review_candidate' WHEN tsup > 0 THEN 'ambiguous' ELSE 'unmapped' END AS mapping_status
  FROM tot LEFT JOIN rk ON rk.rn = 1 AND rk.supplier = tot.supplier AND rk.category_1 = tot.category_1 AND rk.category_2 = tot.category_2),
products AS (SELECT o.supplier, o.supplier_item_id, mp.suggested_categories, mp.mapping_status,
    CASE WHEN mapping_status IN ('strong_candidate', 'review_candidate') THEN 'review_only' WHEN mapping_status = 'ambiguous' THEN 'blocked_ambiguous_category' ELSE 'blocked_unmapped' END AS proposal_status
  FROM matches m JOIN offers o ON o.supplier = m.supplier AND o.supplier_item_id = m.supplier_item_id JOIN mapping mp ON mp.supplier = o.supplier AND mp.category_1 = o.category_1 AND mp.category_2 = o.category_2 WHERE m.status = 'unmatched')"""

STREAK = f"""WITH seen AS ({SEEN_SQL}), runs AS (SELECT DISTINCT run FROM seen), prods AS (SELECT DISTINCT supplier, product_id FROM seen),
presence AS (SELECT p.supplier, p.product_id, r.run, s.run IS NULL AS missing FROM prods p CROSS JOIN runs r LEFT JOIN seen s ON s.supplier = p.supplier AND s.product_id = p.product_id AND s.run = r.run WHERE r.run % 7 <> 6),
isl AS (SELECT *, sum(CASE WHEN missing THEN 0 ELSE 1 END) OVER (PARTITION BY supplier, product_id ORDER BY run ROWS UNBOUNDED PRECEDING) AS island FROM presence),
streaks AS (SELECT supplier, product_id, run, sum(CASE WHEN missing THEN 1 ELSE 0 END) OVER (PARTITION BY supplier, product_id, island ORDER BY run ROWS UNBOUNDED PRECEDING) AS n FROM isl)"""

#: The counter after the last complete run; when a product that was ever missing was last seen
#: since, and last missing.
_STATE = f"""{STREAK}, first_gone AS (SELECT supplier, product_id, min(run) AS gone FROM presence WHERE missing GROUP BY ALL)
SELECT p.supplier, p.product_id, CAST(arg_max(s.n, p.run) AS BIGINT) AS n, CAST(max(p.run) FILTER (NOT p.missing AND p.run > gone) AS BIGINT) AS last_seen_run, CAST(max(p.run) FILTER (p.missing) AS BIGINT) AS last_missing_run
FROM presence p JOIN streaks s ON s.supplier = p.supplier AND s.product_id = p.product_id AND s.run = p.run LEFT JOIN first_gone g ON g.supplier = p.supplier AND g.product_id = p.product_id GROUP BY ALL"""

_N = "CAST(count(*) FILTER ({}) AS BIGINT)"

CATALOG: dict[str, str] = {
    "match_cascade": f"{MATCH} SELECT supplier, supplier_item_id, catalog_product_id, status, CAST(confidence_pct AS BIGINT) AS confidence_pct, coalesce(matched_by, '') AS matched_by, warnings FROM matches",
    "match_status_counts": f"{MATCH} SELECT status, coalesce(matched_by, '') AS matched_by, count(*) AS n FROM matches GROUP BY ALL",
    "catalog_missing": f"{MISSING} SELECT supplier, product_id, sku FROM missing",
    "match_key_multiplicity": f"{MATCH} SELECT 'sku' AS key_kind, n AS hits, count(*) AS n_keys FROM cs GROUP BY n UNION ALL SELECT 'ean', n, count(*) FROM ce GROUP BY n UNION ALL SELECT 'brand_model', n, count(*) FROM cb GROUP BY n",
    "own_key_counts": f"{MATCH} SELECT 'ean' AS key_kind, n AS own, count(*) AS n_keys FROM oe GROUP BY n UNION ALL SELECT 'brand_model', n, count(*) FROM ob GROUP BY n",
    "price_proposals": f"{PRICES} SELECT supplier, supplier_item_id, catalog_product_id, CAST(proposed_e4 AS BIGINT) AS proposed_e4, CAST(delta_e4 AS BIGINT) AS delta_e4, status, coalesce(warning, '') AS warning FROM proposals",
    "proposal_status_counts": f"{PRICES} SELECT supplier, status, count(*) AS n FROM proposals GROUP BY ALL",
    "price_compare": f"{PRICES} SELECT supplier, {_N.format("currency = 'RUR' AND price_cents = cur")} AS equal, {_N.format("currency = 'RUR' AND price_cents > cur")} AS source_higher, {_N.format("currency = 'RUR' AND price_cents < cur")} AS source_lower, {_N.format("currency <> 'RUR'")} AS not_comparable FROM proposals WHERE ms = 'exact' GROUP BY supplier",
    "availability_compare": f"{PRICES} SELECT supplier, {_N.format('available AND quantity > 0')} AS both_available, {_N.format('available AND quantity <= 0')} AS source_only_available, {_N.format('NOT available AND quantity > 0')} AS catalog_only_available, {_N.format('NOT available AND quantity <= 0')} AS both_unavailable FROM proposals WHERE ms = 'exact' GROUP BY supplier",
    "category_mapping": f"{CATEGORY} SELECT supplier, category_1, category_2, source_total, source_only_products, exact_support, suggested_category_ids, suggested_categories, dominant_support, n_alternatives, mapping_status FROM mapping",
    "product_category_proposals": f"{CATEGORY} SELECT supplier, supplier_item_id, suggested_categories, mapping_status, proposal_status FROM products",
    "category_summary": f"{CATEGORY} SELECT mp.supplier, count(*) AS source_categories, {_N.format("mapping_status = 'strong_candidate'")} AS strong, {_N.format("mapping_status = 'review_candidate'")} AS review, {_N.format("mapping_status = 'ambiguous'")} AS ambiguous, {_N.format("mapping_status = 'unmapped'")} AS unmapped, (SELECT count(*) FROM products p WHERE p.supplier = mp.supplier) AS source_only_products FROM mapping mp GROUP BY mp.supplier",
    "review_queue": f"{MATCH} SELECT m.supplier, m.supplier_item_id, m.status, o.ean AS source_ean, k.ean AS catalog_ean, o.mpn AS source_mpn, k.model AS catalog_model FROM matches m JOIN offers o ON o.supplier = m.supplier AND o.supplier_item_id = m.supplier_item_id LEFT JOIN catalog k ON k.supplier = m.supplier AND k.product_id = m.catalog_product_id WHERE m.status IN ('conflict', 'high_confidence', 'ambiguous')",
    "source_only": f"{MATCH} SELECT o.supplier, o.supplier_item_id, o.name, o.price_cents FROM offers o JOIN matches m ON m.supplier = o.supplier AND m.supplier_item_id = o.supplier_item_id WHERE m.status = 'unmatched'",
    "identity_coverage": f"{BASE} SELECT supplier, count(*) AS source_items, {_N.format("coalesce(ean, '') <> ''")} AS with_ean, {_N.format("coalesce(mpn, '') <> ''")} AS with_mpn, {_N.format("coalesce(manufacturer, '') <> ''")} AS with_manufacturer FROM offers GROUP BY supplier",
    "feed_completeness": f"{MISSING} SELECT c.supplier, (SELECT count(*) FROM offers o WHERE o.supplier = c.supplier) AS source_items, count(*) AS scope, (SELECT count(*) FROM missing m WHERE m.supplier = c.supplier) AS missing, CASE WHEN (SELECT count(*) FROM missing m WHERE m.supplier = c.supplier) = 0 THEN 'complete' ELSE 'incomplete' END AS feed_status FROM catalog c GROUP BY c.supplier",
    "run_summary": PRICES.replace("proposals AS (", "missing AS (SELECT c.supplier, c.product_id FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.supplier = c.supplier AND m.catalog_product_id = c.product_id)), proposals AS (") + f" SELECT p.supplier, count(*) AS source_items, {_N.format('available')} AS source_available, {_N.format("ms = 'exact'")} AS exact, {_N.format("ms = 'unmatched'")} AS source_only, {_N.format("ms IN ('conflict', 'high_confidence', 'ambiguous')")} AS review, {_N.format("status = 'ready_for_review'")} AS ready, (SELECT count(*) FROM missing m WHERE m.supplier = p.supplier) AS missing FROM proposals p GROUP BY p.supplier",
    "missing_streaks": f"{STREAK} SELECT supplier, product_id, CAST(max(n) AS BIGINT) AS longest, CAST(arg_max(n, run) AS BIGINT) AS present, count(*) AS n_runs FROM streaks GROUP BY ALL",
    "missing_state_step": _STATE,
    "missing_state_step_all": _STATE,
    "missing_state_stream": _STATE,
    "missing_state_stream_all": _STATE,
    "missing_keyed_stream": _STATE,
    "quarantine_proposals": f"{STREAK} SELECT supplier, product_id, CAST(n AS BIGINT) AS n FROM streaks WHERE run = (SELECT max(run) FROM streaks) AND n >= 70",
    "category_paths": f"WITH RECURSIVE cats AS ({CATEGORIES_SQL}), walk AS (SELECT id, name AS path FROM cats WHERE parent_id IS NULL UNION ALL SELECT c.id, w.path || '/' || c.name FROM cats c JOIN walk w ON c.parent_id = w.id) SELECT id, path FROM walk",
    "reject_duplicates": "SELECT l_suppkey AS supplier, 'duplicate_product' AS rule, CAST(l_partkey AS VARCHAR) AS row_key FROM lineitem GROUP BY l_suppkey, l_partkey HAVING count(*) > 1",
    "reject_referential": f"{BASE} SELECT supplier, 'product_not_offered' AS rule, sku AS row_key FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM offers o WHERE o.supplier = c.supplier AND o.catalog_sku = c.sku)",
    "reject_row_rules": f"{BASE} SELECT supplier, rule, supplier_item_id AS row_key FROM (SELECT supplier, supplier_item_id, unnest([CASE WHEN coalesce(manufacturer, '') = '' THEN 'missing_manufacturer' END, CASE WHEN coalesce(mpn, '') = '' THEN 'missing_mpn' END, CASE WHEN coalesce(ean, '') = '' THEN 'missing_ean' END]) AS rule FROM offers) WHERE rule IS NOT NULL",
    "blocked_snapshots": f"{BASE} SELECT supplier, count(*) AS n_rejects FROM offers WHERE price_cents = 0 AND currency = 'USD' GROUP BY supplier",
    "batch_status": f"{BASE}, bad AS (SELECT DISTINCT supplier FROM offers WHERE price_cents = 0 AND currency = 'USD') SELECT supplier, CASE WHEN supplier IN (SELECT supplier FROM bad) THEN 'BLOCKED' ELSE 'PASS' END AS status FROM (SELECT DISTINCT supplier FROM offers)",
    "xml_offer_roundtrip": f"{BASE} SELECT supplier, supplier_item_id, ean, mpn, price_cents, available FROM offers",
    "xml_attribute_map": f"{BASE} SELECT supplier, supplier_item_id, 'price' AS k, CAST(price_cents AS VARCHAR) AS v FROM offers UNION ALL SELECT supplier, supplier_item_id, 'param:cat', category_1 FROM offers UNION ALL SELECT supplier, supplier_item_id, 'param:cat#2', category_2 FROM offers UNION ALL SELECT supplier, supplier_item_id, '@id', supplier_item_id FROM offers",
    "property_long": "SELECT p_partkey AS item_id, prop AS property_id, val AS value, val IN ('', '-') AS missing FROM (SELECT p_partkey, unnest(['p1', 'p2', 'p3']) AS prop, unnest([p_brand, CASE WHEN p_size % 7 = 0 THEN '-' ELSE p_type END, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END]) AS val FROM part)",
    "property_stats": "SELECT CAST(3 AS BIGINT) AS properties, count(*) + count(*) FILTER (p_size % 7 <> 0) AS known_values, count(DISTINCT p_partkey) AS items_with_values, count(DISTINCT p_partkey) AS items, 3 * count(*) AS observations, CAST(count(*) FILTER (p_size % 7 = 0) + count(*) FILTER (p_size % 5 = 0) AS BIGINT) AS missing, count(*) AS undefined, CAST(1 AS BIGINT) AS undefined_properties FROM part",
    "availability_resolve": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' OR l_quantity - 25 <= 0 AND l_partkey % 4 <> 0 THEN false WHEN l_partkey % 3 = 0 THEN true WHEN l_partkey % 4 <> 0 THEN l_quantity - 25 > 0 ELSE true END AS available FROM lineitem",
    "token_parse": "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN true WHEN event_id % 5 = 1 THEN false WHEN event_id % 5 = 2 THEN true WHEN event_id % 5 = 3 THEN false END AS flag, CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS INTEGER) END AS quantity FROM events",
    "seal_diff": "SELECT status, count(*) AS n FROM (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'missing' WHEN p_partkey % 10 = 1 THEN 'extra' WHEN p_partkey % 10 = 2 THEN 'changed' ELSE 'unchanged' END AS status FROM part) GROUP BY status",
    "ledger_dedupe": "SELECT supplier, content FROM (SELECT DISTINCT l_suppkey AS supplier, l_partkey AS content FROM lineitem WHERE l_returnflag = 'N') a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'A' AND b.l_suppkey = a.supplier AND b.l_partkey = a.content)",
    "latest_snapshot": "SELECT o_custkey AS supplier, CAST(max(o_orderkey) AS VARCHAR) AS content_sha256 FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS last FROM orders WHERE o_orderstatus <> 'P') WHERE o_orderdate = last GROUP BY o_custkey",
    "csv_safe_text": "SELECT doc_id, CASE WHEN regexp_matches(t, '^[ \\t\\r\\n]*[=+\\-@]') THEN '''' || t ELSE t END AS cell FROM (SELECT doc_id, text AS t FROM documents UNION ALL SELECT doc_id, concat(CASE doc_id % 5 WHEN 0 THEN '=' WHEN 1 THEN ' +' WHEN 2 THEN chr(9) || '-' WHEN 3 THEN '@' ELSE '' END, text) FROM documents)",
    "inline_secret_scan": "SELECT doc_id, regexp_matches(replace(text, '\"', ': '), '(^|\\n)\\s*(?i:password|passwd|token|api[_-]?key|secret)\\s*:\\s*[''\"]?\\S+') AS has_secret FROM documents",
    "url_allowlist": "SELECT page_id, regexp_matches(url, '^https://(?:www\\.ththhe\\.example\\.com|thther\\.example\\.org)(?::443)?/[^?#]*$') AS allowed FROM pages",
    # Buckets of as many first digits of the hash as hold 1024 rows each in the mean; then three digits fewer at a time, until none is left.
    "table_digest": """WITH RECURSIVE rows_ AS (SELECT sha256('{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || ',"l_returnflag":"' || l_returnflag || '"}') AS h FROM lineitem),
counted AS (SELECT h, count(*) AS n FROM rows_ GROUP BY h), wide AS (SELECT min(k) AS w FROM range(16) AS r(k) WHERE CAST(1024 AS HUGEINT) * CAST(16 AS HUGEINT) ** k >= (SELECT count(*) FROM counted)),
folded AS (SELECT w, substring(h, 1, w) AS b, sha256(string_agg(h || ':' || n, chr(10) ORDER BY h)) AS d FROM counted, wide GROUP BY w, substring(h, 1, w)
  UNION ALL SELECT greatest(0, w - 3), substring(b, 1, greatest(0, w - 3)), sha256(string_agg(b || ':' || d, chr(10) ORDER BY b)) FROM folded WHERE w > 0 GROUP BY w, substring(b, 1, greatest(0, w - 3)))
SELECT copy, (SELECT CAST(sum(n) AS BIGINT) FROM counted) AS n_rows, d AS digest FROM folded, (SELECT 'stored' AS copy UNION ALL SELECT 'dealt anew') WHERE w = 0""",
    "verify_checks": f"{BASE} SELECT DISTINCT supplier, 'PASS' AS status, CAST(10 AS BIGINT) AS n_passed, CAST(0 AS BIGINT) AS n_failed FROM offers",
}

RUN_SUMMARY = CATALOG["run_summary"]
