"""Offers, catalogue, runs and categories as derived from the star-schema tables.

A stand-in for landed feeds: the same rows at any scale, with every branch of the match present.
Money is in whole cents so that engines agree.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_OFFER_SQL = """
SELECT s AS supplier, CAST(k AS STRING) AS supplier_item_id, k AS feed_pos,
  concat(CAST(s AS STRING), '-', CAST(k AS STRING)) AS catalog_sku,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 5 = 0 THEN lower(p_brand) ELSE p_brand END AS manufacturer,
  CASE WHEN k % 13 = 0 THEN NULL WHEN k % 63 = 0 THEN 'DUP' ELSE concat(p_type, ' ', CAST(k AS STRING)) END AS mpn,
  CAST(NULL AS STRING) AS model,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 29 = 0 THEN concat('99', CAST(k % 3 AS STRING))
       ELSE concat('46', lpad(CAST(k AS STRING), 9, '0')) END AS ean,
  CASE WHEN k % 97 = 0 THEN 'ambiguous_ean' END AS identity_warning,
  CASE WHEN k % 41 = 0 THEN 0 ELSE CAST(floor(unit_price * 100 + 0.5) AS BIGINT) END AS price_cents,
  CASE WHEN k % 19 = 0 THEN 'USD' ELSE 'RUR' END AS currency, k % 3 <> 0 AS available,
  p_type AS category_1, p_name AS category_2, p_name AS name"""

OFFERS_SQL = f"""{_OFFER_SQL}
FROM (SELECT l_suppkey AS s, l_partkey AS k, max(l_extendedprice / l_quantity) AS unit_price
      FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY l_suppkey, l_partkey) AS x
JOIN part ON p_partkey = k"""

_PRODUCT_SQL = """
SELECT s AS supplier, s * 1000000 + k + 1 AS product_id,
  concat(CAST(s AS STRING), '-', CASE WHEN k % 7 = 0 THEN concat('X', CAST(k AS STRING))
    WHEN k % 50 = 1 THEN concat(CAST(k - 1 AS STRING), '0') ELSE CAST(k AS STRING) END) AS sku,
  CASE WHEN k % 23 = 0 THEN 'OTHER' WHEN k % 63 = 0 THEN 'dup' ELSE concat(upper(p_type), '-', CAST(k AS STRING)) END AS model,
  CASE WHEN k % 9 = 0 THEN '' WHEN k % 37 = 0 THEN concat('47', lpad(CAST(k AS STRING), 9, '0'))
       WHEN k % 29 = 0 THEN concat('99', CAST(k % 3 AS STRING)) ELSE concat('46', lpad(CAST(k AS STRING), 9, '0')) END AS ean,
  CASE WHEN k % 31 = 0 THEN 'NoBrand' ELSE p_brand END AS manufacturer, p_name AS name,
  CAST(floor(unit_price * 100 + 0.5) AS BIGINT) AS price_cents, CAST(most AS BIGINT) % 4 AS quantity, 1 AS status,
  CAST(p_size % 10 AS STRING) AS category_ids, p_type AS categories"""

CATALOG_SQL = f"""{_PRODUCT_SQL}
FROM (SELECT l_suppkey AS s, l_partkey AS k, max(l_extendedprice / l_quantity) AS unit_price, max(l_quantity) AS most
      FROM lineitem WHERE l_returnflag IN ('N', 'R') GROUP BY l_suppkey, l_partkey) AS x
JOIN part ON p_partkey = k"""

#: A row for each supplier and part, from which ``offers_from`` and ``catalog_from`` take what the two queries above do: the order
#: lines are dealt by part once, which serves the grouping and the join alike, whatever the size of ``part``.
PAIRS_SQL = """
SELECT /*+ SHUFFLE_HASH(p) */ x.*, p_name, p_brand, p_type, p_size
FROM (SELECT l_suppkey AS s, l_partkey AS k, bool_or(offered) AS offered, bool_or(stocked) AS stocked, max(CASE WHEN offered THEN unit_price END) AS offer_price,
        max(CASE WHEN stocked THEN unit_price END) AS stock_price, max(CASE WHEN stocked THEN l_quantity END) AS most
      FROM (SELECT l_suppkey, l_partkey, l_quantity, l_extendedprice / l_quantity AS unit_price, l_returnflag IN ('A', 'N') AS offered, l_returnflag IN ('N', 'R') AS stocked
            FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') DISTRIBUTE BY l_partkey) AS l
      GROUP BY l_suppkey, l_partkey) AS x
JOIN part AS p ON p_partkey = k"""

#: A product of a run: the month of shipping is the run, every 7th run is incomplete.
SEEN_SQL = """
SELECT DISTINCT l_suppkey AS supplier, l_suppkey * 1000000 + l_partkey + 1 AS product_id,
  CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1 AS BIGINT) AS run
FROM lineitem"""

CATEGORIES_SQL = """
SELECT concat('r', CAST(r_regionkey AS STRING)) AS id, r_name AS name, CAST(NULL AS STRING) AS parent_id FROM region
UNION ALL SELECT concat('n', CAST(n_nationkey AS STRING)), n_name, concat('r', CAST(n_regionkey AS STRING)) FROM nation
UNION ALL SELECT concat('s', CAST(s_suppkey AS STRING)), s_name, concat('n', CAST(s_nationkey AS STRING)) FROM supplier"""


def star(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def derived(spark: SparkSession, sf_dir: str, sql: str, names: tuple[str, ...]) -> DataFrame:
    """A query over star-schema tables, which it names."""
    tables = star(spark, sf_dir, *names)
    for n in names:
        sql = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", sql)
    return spark.sql(sql, **tables)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, OFFERS_SQL, ("lineitem", "part"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CATALOG_SQL, ("lineitem", "part"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``offers`` and ``catalog`` before their columns are made."""
    return derived(spark, sf_dir, PAIRS_SQL, ("lineitem", "part"))


def offers_from(rows: DataFrame, *more: str) -> DataFrame:
    """``offers`` from the rows of ``pairs``, with ``more`` of their columns."""
    return rows.sparkSession.sql(f"{', '.join([_OFFER_SQL, *more])}\nFROM {{rows}} WHERE offered", rows=rows.withColumnRenamed("offer_price", "unit_price"))


def catalog_from(rows: DataFrame) -> DataFrame:
    """``catalog`` from the rows of ``pairs``."""
    return rows.sparkSession.sql(f"{_PRODUCT_SQL}\nFROM {{rows}} WHERE stocked", rows=rows.withColumnRenamed("stock_price", "unit_price"))


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, SEEN_SQL, ("lineitem",))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CATEGORIES_SQL, ("region", "nation", "supplier"))
