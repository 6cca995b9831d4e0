"""Registered queries on bundles, property feeds and adapters: written as files, spoiled, read back and judged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.functions.store import fresh_folder, stored
from tallybridge.plans import catalogue
from tallybridge.plans.landing import _spark
from tallybridge.plans.oracle import BASE
from tallybridge.sources import adapters, bundle, feeds, views


def _files(spark: SparkSession, sf: str) -> str:
    """A bundle of one file for each size of part."""
    folder = fresh_folder(spark, "bundle")
    part = views.star(spark, sf, "part")["part"]
    part.select("p_size", F.concat_ws(",", "p_partkey", "p_name").alias("line")).repartition("p_size").sortWithinPartitions("p_size", "line").write.partitionBy("p_size").text(folder)
    return folder


def bundle_seal(spark, sf):
    """A bundle is sealed, then files are taken away, changed and added: what the seal says of it."""
    folder = _files(spark, sf)
    bundle.seal(spark, folder)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    listing = fs.listFiles(jvm.Path(folder), True)
    while listing.hasNext():  # 50 sizes
        path = listing.next().getPath()
        name = path.getParent().getName()
        if name.startswith("p_size=") and not path.getName().startswith(("_", ".")):
            turn = int(name[7:]) % 10
            if turn == 1:
                fs.delete(path, False)
            elif turn == 2:
                out = fs.create(path, True)
                out.write(b"other\n")
                out.close()
    extra = fs.create(jvm.Path(f"{folder}/p_size=0/extra.txt"), True)
    extra.write(b"x")
    extra.close()
    return bundle.check_seal(spark, folder).select(F.substring_index("path", "/", 1).alias("folder"), "status")


def bundle_listing(spark, sf):
    """Relative folders, sizes and hashes of a bundle's files; the larger ones are hashed in pieces."""
    listed = bundle.list_files(spark, _files(spark, sf), whole_bytes=1000)
    return listed.select(F.substring_index("path", "/", 1).alias("folder"), "size", "sha256")


MANIFESTS_SQL = """
SELECT CAST(s_suppkey AS STRING) AS supplier, HASH(CAST(s_suppkey AS STRING)) AS source, HASH(concat('c', CAST(s_suppkey AS STRING))) AS catalog,
  HASH(concat('p', CAST(s_suppkey AS STRING))) AS policy, CAST(s_suppkey AS BIGINT) AS k FROM supplier"""


def manifest_rejects(spark, sf):
    """Manifests of runs written as JSON and read again: what is wrong with the spoiled ones."""
    rows = _spark(spark, sf, MANIFESTS_SQL, "supplier")
    k = F.col("k")
    record = lambda name, sha, path, size: F.struct(F.lit(name).alias("original_name"), path.alias("bundle_path"), sha.alias("sha256"), size.alias("size"))
    source = record("feed.xml", F.when(k % 5 == 0, "x").otherwise(F.col("source")), F.when(k % 6 == 0, "../feed.xml").otherwise("inputs/source.xml"), k)
    catalog = record("catalog.csv", F.col("catalog"), F.lit("inputs/catalog.csv"), F.when(k % 7 == 0, -1).otherwise(k).cast("long"))
    ours = bundle.run_id(F.col("supplier"), source["sha256"], F.col("catalog"), F.col("policy"))
    inputs = F.map_from_arrays(F.array(F.lit("source"), F.lit("catalog")), F.array(source, catalog))
    made = rows.select(
        F.when(k % 4 == 0, "2").otherwise("1").alias("manifest_version"),
        F.when(k % 3 == 0, F.concat(ours, F.lit("x"))).otherwise(ours).alias("run_id"),
        "supplier",
        inputs.alias("inputs"),
        F.col("policy").alias("policy_sha256"),
        F.when(k % 11 == 0, 1).otherwise(0).alias("production_writes"),
    )
    folder = fresh_folder(spark, "manifests")
    bundle.write_manifest(made, folder)
    _, bad = bundle.read_manifest(spark, folder)
    return bad.select(F.split("run_id", "-")[0].alias("supplier"), "rule")


def _property_file(spark: SparkSession, sf: str) -> str:
    """A property feed with faults at fixed remainders of the part."""
    folder = fresh_folder(spark, "properties")
    part = views.star(spark, sf, "part")["part"]
    k = F.col("p_partkey")
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    size = tag("p2", F.when(F.col("p_size") % 7 == 0, "-").otherwise(F.col("p_size").cast("string")))
    cells = F.concat(tag("p1", F.col("p_brand")), size, F.when(k % 11 == 0, tag("p9", F.lit("u"))).otherwise(""), F.when(k % 13 == 0, tag("p1", F.lit("again"))).otherwise(""), F.when(k % 17 == 0, tag("x1", F.lit("t"))).otherwise(""))
    line = F.concat(F.lit('<item id="'), F.when(k % 19 == 0, F.lit("0x")).otherwise(""), k.cast("string"), F.lit('">'), cells, F.lit("</item>"))
    items = part.select(line.alias("value")).union(part.where(k % 23 == 0).select(F.concat(F.lit('<item id="'), k.cast("string"), F.lit('"></item>'))))
    head = '<xml_catalog date="2031-03-07 08:15"><properties><property id="p1">brand</property><property id="p2">size</property><property id="p2">size again</property><property id="p3"></property></properties><items>'
    spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{folder}/a")
    items.write.text(f"{folder}/b")
    return folder


def property_feed_rejects(spark, sf):
    """Faults of a property feed by rule, properties without a definition refused."""
    return feeds.property_rejects(spark, f"{_property_file(spark, sf)}/*").groupBy("rule").agg(F.count("*").alias("n"))


def property_feed_rows(spark, sf):
    """Observations of a property feed, properties without a definition kept as such."""
    definitions, observed = feeds.read_properties(spark, f"{_property_file(spark, sf)}/*")
    rows = feeds.property_observations(observed, definitions.dropDuplicates(["property_id"]).select("property_id", F.col("property_id").alias("property_name")))
    return rows.groupBy("property_id", "missing", "definition_missing").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("n_items"))


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s_suppkey")
    adapter = F.get(F.array(F.lit("11"), F.lit("31"), F.lit("41"), F.lit("51")), (s % 4).cast("int"))
    prefix = F.when(s % 5 == 0, "99").otherwise(adapter)
    root = F.when(s % 7 == 0, "html").when(adapter == "31", "xml_catalog").otherwise("yml_catalog")
    return views.star(spark, sf, "supplier")["supplier"].select(s.cast("long").alias("supplier"), adapter.alias("adapter"), prefix.alias("prefix"), root.alias("root"))


def adapter_rejects(spark, sf):
    return adapters.rejects(_registry(spark, sf))


def adapter_offers(spark, sf):
    """Feeds of three dialects read by the adapters that the registry names; those of others are not read."""
    folder = fresh_folder(spark, "adapters")
    registry = _registry(spark, sf)
    ours = catalogue.offers_of(spark, sf).select("supplier", "feed_pos", "supplier_item_id", "manufacturer", "price_cents", "available")
    rows = stored(ours.join(registry.select("supplier", "adapter"), "supplier"), "adapter-offers")
    old, third = F.col("adapter") == "31", F.col("adapter") == "41"
    tag = lambda name, c, when: F.when(when & c.isNotNull(), F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))).otherwise("")
    price, item = F.col("price_cents").cast("string"), F.col("supplier_item_id")
    stated = F.when(F.col("feed_pos") % 2 == 0, F.concat(F.lit('" available="'), F.col("available").cast("string"))).otherwise("")
    body = [tag("price", price, ~old), tag("priceE", price, old), tag("vendor", F.col("manufacturer"), ~old), tag("Vendor", F.col("manufacturer"), old), tag("quantity", (F.col("feed_pos") % 5 - 2).cast("string"), third), tag("count", F.lit("***"), old), tag("barcode", item, ~old), tag("barcode", F.lit("2"), ~old)]
    line = F.concat(F.lit('<offer id="'), item, stated, F.lit('">'), *body, F.lit("</offer>"))
    lines = rows.select("adapter", "supplier", F.col("feed_pos").alias("pos"), line.alias("value"))
    for pos, text in ((-1, "<feed><shop><offers>"), (1 << 40, "</offers></shop></feed>")):
        lines = lines.union(rows.select("adapter", "supplier").distinct().select("adapter", "supplier", F.lit(pos).cast("long"), F.lit(text)))
    feed = lines.repartition("supplier").sortWithinPartitions("adapter", "supplier", "pos").select("adapter", "supplier", "value")
    # A file for each supplier: tasks move their own files to their places, not the driver all of them.
    feed.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("adapter", "supplier").text(folder)
    offers, _ = adapters.read(spark, registry, folder, by_adapter=True)
    return offers.select("supplier", "adapter", "supplier_item_id", "catalog_sku", "manufacturer", (F.col("source_price")).cast("long").alias("price"), "quantity", "available", F.array_join("identity_warnings", ",").alias("warnings"), F.array_join(F.array_sort("refused"), ",").alias("refused"))


_ALL = [bundle_seal, bundle_listing, manifest_rejects, property_feed_rejects, property_feed_rows, adapter_rejects, adapter_offers]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: q for q in _ALL}

_REGISTRY = """registry AS (SELECT CAST(s_suppkey AS BIGINT) AS supplier, ['11', '31', '41', '51'][s_suppkey % 4 + 1] AS adapter FROM supplier),
adapter_rules AS (SELECT supplier, adapter, unnest([CASE WHEN adapter = '51' THEN 'unknown_adapter' END, CASE WHEN adapter <> '51' AND supplier % 5 = 0 THEN 'adapter_prefix' END,
  CASE WHEN adapter <> '51' AND supplier % 7 = 0 THEN 'adapter_root' END]) AS rule FROM registry),
adapter_rejects AS (SELECT supplier, rule, adapter AS row_key FROM adapter_rules WHERE rule IS NOT NULL)"""
_QUANTITY = "CASE WHEN adapter = '41' THEN feed_pos % 5 - 2 END"
_STATED = "CASE WHEN feed_pos % 2 = 0 THEN available END"
_CELLS = """cells AS (
  SELECT CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey END AS item, p_partkey AS k, unnest(['p1', 'p2', CASE WHEN p_partkey % 11 = 0 THEN 'p9' END, CASE WHEN p_partkey % 13 = 0 THEN 'p1' END, CASE WHEN p_partkey % 17 = 0 THEN 'x1' END]) AS p,
    unnest([false, p_size % 7 = 0, false, false, false]) AS missing FROM part)"""

ORACLE: dict[str, str] = {
    "bundle_seal": """SELECT 'p_size=' || p_size AS folder, CASE p_size % 10 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' ELSE 'unchanged' END AS status FROM (SELECT DISTINCT p_size FROM part)
UNION ALL SELECT 'p_size=0', 'extra'""",
    "bundle_listing": """SELECT 'p_size=' || p_size AS folder, strlen(body)::BIGINT AS size, sha256(body) AS sha256
FROM (SELECT p_size, string_agg(line || chr(10), '' ORDER BY line) AS body FROM (SELECT p_size, p_partkey || ',' || p_name AS line FROM part) GROUP BY p_size)""",
    "manifest_rejects": """SELECT supplier, rule FROM (SELECT CAST(s_suppkey AS VARCHAR) AS supplier, unnest([CASE WHEN s_suppkey % 4 = 0 THEN 'manifest_version' END, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 6 = 0 THEN 'source_record' END,
  CASE WHEN s_suppkey % 7 = 0 THEN 'catalog_record' END, CASE WHEN s_suppkey % 3 = 0 THEN 'run_id' END, CASE WHEN s_suppkey % 11 = 0 THEN 'production_writes' END]) AS rule FROM supplier) WHERE rule IS NOT NULL""",
    "property_feed_rejects": f"""WITH {_CELLS}, used AS (SELECT DISTINCT k, item, p FROM cells WHERE p IS NOT NULL), rules AS (
  SELECT 'repeated_definition' AS rule, 1 AS n UNION ALL SELECT 'property_name', 1
  UNION ALL SELECT 'item_id', count(*) + count(*) FILTER (p_partkey = 0) FROM part WHERE p_partkey % 19 = 0
  UNION ALL SELECT 'repeated_item', count(*) FROM part WHERE p_partkey % 23 = 0 AND p_partkey % 19 <> 0
  UNION ALL SELECT 'repeated_property', count(*) FROM part WHERE p_partkey % 13 = 0
  UNION ALL SELECT 'property_tag', count(*) FROM part WHERE p_partkey % 17 = 0
  UNION ALL SELECT 'unknown_property', count(*) FROM part WHERE p_partkey % 11 = 0)
SELECT rule, n FROM rules WHERE n > 0""",
    "property_feed_rows": f"WITH {_CELLS} SELECT p AS property_id, missing, p NOT IN ('p1', 'p2', 'p3') AS definition_missing, count(*) AS n, count(DISTINCT item) AS n_items FROM cells WHERE p IS NOT NULL AND item IS NOT NULL GROUP BY ALL",
    "adapter_rejects": f"WITH {_REGISTRY} SELECT supplier, rule, row_key FROM adapter_rejects",
    "adapter_offers": f"""{BASE}, {_REGISTRY} SELECT o.supplier, adapter, supplier_item_id, adapter || supplier_item_id AS catalog_sku, manufacturer, price_cents AS price, CAST({_QUANTITY} AS INTEGER) AS quantity,
  CASE WHEN adapter = '11' THEN coalesce({_STATED}, false) WHEN adapter = '41' THEN {_QUANTITY} > 0 AND coalesce({_STATED}, true) ELSE coalesce({_STATED}, true) END AS available,
  CASE WHEN adapter = '11' AND supplier_item_id <> '2' THEN 'ambiguous_ean' ELSE '' END AS warnings, CASE WHEN adapter <> '11' AND price_cents <= 0 THEN 'price_not_positive' ELSE '' END AS refused
FROM offers AS o JOIN registry USING (supplier) WHERE supplier NOT IN (SELECT supplier FROM adapter_rejects)""",
}
