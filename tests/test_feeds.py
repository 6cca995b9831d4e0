"""XML and CSV scans on small files of each dialect."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tallybridge.functions import text as T
from tallybridge.sinks import export
from tallybridge.sources import feeds

YML = """<?xml version="1.0" encoding="utf-8"?>
<yml_catalog date="2031-03-07 08:15"><shop><currencies><currency id="RUR" rate="1"/><currency id="USD"/></currencies>
<categories><category id="1">A &amp; B</category><category id="2" parentId="1">C</category></categories><offers>
<offer id="5" available="yes"><price>10.50</price><currencyId>RUR</currencyId><categoryId>2</categoryId><name>A <b>bold</b> c</name><vendor>V</vendor><vendorCode>X1</vendorCode><barcode>0460</barcode><picture>u1</picture><picture>u2</picture><param name="k">1</param><param name="k">2</param></offer>
<offer id="6"><price>1</price><price>2</price><barcode>1</barcode><barcode>2</barcode><name>n</name></offer>
</offers></shop></yml_catalog>"""
STOCK = """<xml_catalog date="2031-03-07 08:15"><offers>
<offer id="1"><priceE>5</priceE><name>a</name><count>***</count><GTIN>04612345678907</GTIN></offer>
<offer id="2"><priceE>5</priceE><name>b</name><count>-2</count></offer>
<offer id="3"><priceE>5</priceE><name>c</name><count>7</count><OutOfProd>1</OutOfProd></offer>
<offer id="4"><priceE>5</priceE><name>d</name><count>****</count></offer>
</offers></xml_catalog>"""


def test_first_dialect(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(YML)
    path, m = str(tmp_path / "feed.xml"), feeds.DIALECTS["11"]
    rows = {r["supplier_item_id"]: r for r in feeds.normalise(feeds.read_offers(spark, path, m), m).collect()}
    a, b = rows["5"], rows["6"]
    assert (a["catalog_sku"], a["name"], a["ean"], float(a["source_price"]), a["available"], a["image_urls"]) == ("115", "A", "0460", 10.5, True, ["u1", "u2"])
    assert b["source_price"] is None and b["conflicts"] == ["price"] and b["identity_warnings"] == ["ambiguous_ean"] and b["ean"] is None and b["available"] is False
    assert {r["id"]: (r["name"], r["parent_id"]) for r in feeds.read_categories(spark, path).collect()} == {"1": ("A & B", None), "2": ("C", "1")}
    assert {r["currency"]: float(r["rate"]) for r in feeds.read_currencies(spark, path).collect()} == {"RUR": 1.0, "USD": 1.0}
    assert feeds.read_header(spark, path).first()["feed_date"] == "2031-03-07 08:15"


def test_attribute_map_numbers_repeats(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(YML)
    rows = feeds.fragment_elements(feeds.read_fragments(spark, str(tmp_path / "feed.xml"))).select(feeds.attribute_map(F.col("elements")).alias("m"))
    m = next(r["m"] for r in rows.collect() if r["m"]["@id"] == "5")
    assert m["param:k"] == "1" and m["param:k#2"] == "2" and m["picture#2"] == "u2" and m["name"] == "A bold c"


def test_stock_symbols_and_zip(spark, tmp_path):
    m = feeds.DIALECTS["31"]
    (tmp_path / "feed.xml").write_text(STOCK)
    got = {r["supplier_item_id"]: (r["quantity"], r["available"], r["ean"]) for r in feeds.normalise(feeds.read_offers(spark, str(tmp_path / "feed.xml"), m), m).collect()}
    assert got == {"1": (None, True, "04612345678907"), "2": (-2, False, None), "3": (7, False, None), "4": (None, None, None)}
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("Price.xml", STOCK)
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("Price.xml", STOCK)
        z.writestr("other", "x")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    rows = feeds.read_zipped(spark, str(tmp_path / "*.zip"), "Price.xml").collect()
    assert sum(r["fragment"] is not None for r in rows) == 4
    assert sorted(r["problem"] for r in rows if r["problem"]) == ["bad_archive", "unexpected_members"]


def test_text_is_kept_as_written(spark, tmp_path):
    """References are decoded once, a < that opens no tag stays, no number is rounded, bad tokens are refused."""
    (tmp_path / "f.xml").write_text("""<yml_catalog><shop><offers>
<offer id="1" available="maybe"><price>1.23456</price><name>cable &lt;2 m, plug &gt;1 A</name><vendor>AT&amp;amp;T</vendor></offer>
<offer id="2"><name>a <i>b</i></name></offer>
<offer id="a 3" available=" + "><price>-1.5000</price><name><![CDATA[x <b> & y]]></name></offer>
</offers></shop></yml_catalog>""")
    rows = {}
    for dialect in ("11", "41"):
        m = feeds.DIALECTS[dialect]
        for r in feeds.normalise(feeds.read_offers(spark, str(tmp_path / "f.xml"), m), m).collect():
            rows[dialect, r["supplier_item_id"]] = r
    a = rows["11", "1"]
    assert (a["name"], a["manufacturer"], a["source_price"], a["available"], a["refused"]) == ("cable <2 m, plug >1 A", "AT&amp;T", None, False, ["available_token", "price_decimal"])
    assert rows["11", "2"]["source_price"] == 0 and rows["11", "2"]["refused"] == [] and rows["41", "2"]["refused"] == ["price_not_positive"]
    assert rows["11", "a 3"]["refused"] == ["item_id"] and rows["41", "a 3"]["refused"] == ["item_id", "price_not_positive"]
    one = lambda x: spark.range(1).select(T.plain_text(F.lit(x)).alias("x")).first()["x"]
    assert one("<p1>&#65;&#x416; &amp;lt; <b>t</b> <![CDATA[a <b> &amp; c]]> 1 < 2<!-- no --></p1>") == "AЖ &lt; t a <b> &amp; c 1 < 2"
    declared = spark.createDataFrame([('<!DOCTYPE offer [<!ENTITY e "x">]><offer id="1"><name>&e;</name></offer>',), ('<offer id="2"><name><![CDATA[<!ENTITY]]></name></offer>',)], "fragment string")
    assert [r["elements"] is None for r in feeds.fragment_elements(declared).orderBy("fragment").collect()] == [True, False]


def test_properties(spark, tmp_path):
    body = '<xml_catalog date="2031-03-07 08:15"><properties><property id="p1">Цвет</property></properties><items><item id="7"><p1>белый</p1><p2>-</p2></item><item id="8"><p1></p1></item></items></xml_catalog>'
    (tmp_path / "p.xml").write_bytes(body.encode("windows-1251"))
    definitions, observed = feeds.read_properties(spark, str(tmp_path / "p.xml"))
    rows = feeds.property_observations(observed, definitions)
    assert sorted((r["item_id"], r["property_id"], r["property_name"], r["value"], r["missing"], r["definition_missing"]) for r in rows.collect()) == [("7", "p1", "Цвет", "белый", False, False), ("7", "p2", None, "-", True, True), ("8", "p1", "Цвет", "", True, False)]
    assert tuple(feeds.property_stats(rows).first()) == (2, 1, 1, 2, 3, 2, 1, 1)


def test_catalog_headers(spark, tmp_path):
    head = ",".join(feeds.CATALOG_HEADERS)
    (tmp_path / "c.csv").write_text("﻿" + head + ",extra\n1,m,s,0460,n,b,1.5,2,1,3,cat,e\n", encoding="utf-8")
    row = feeds.read_catalog(spark, str(tmp_path / "c.csv")).first()
    assert (row["product_id"], row["ean"], row["extra"]) == ("1", "0460", "e")
    for bad in (head + ",sku", head.replace("ean,", ""), head + ", x"):
        (tmp_path / "b.csv").write_text(bad + "\n")
        with pytest.raises(ValueError):
            feeds.read_catalog(spark, str(tmp_path / "b.csv"))


def test_scalars(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(T.identity_key(F.lit("Straße-1 Ёж"))) == "STRASSE1Ж"
    assert one(T.strict_decimal(F.lit(" 1e3 "))) == 1000 and one(T.strict_decimal(F.lit("NaN"))) is None
    assert one(T.valid_feed_date(F.lit("2026-02-30 10:00"))) is False and one(T.valid_feed_date(F.lit("2026-02-28 10:00"))) is True
    assert one(T.snapshot_name(F.lit("31"), F.lit("2031-03-07 08:15"), F.lit("ab" * 32))) == "31-live-20310307T0815-" + "ab" * 6
    assert one(T.run_name(F.lit("..a b/c-"), F.lit("f" * 64))) == "a-b-c-" + "f" * 12
    assert one(T.url_allowed(F.lit("https://h.example/a?q=1"), ["h.example"])) is False and one(T.url_allowed(F.lit("https://H.example:443/a"), ["h.example"])) is True
    assert one(T.safe_bundle_path(F.lit("a/../b"))) is False and one(T.safe_bundle_path(F.lit("a/b"))) is True
    assert one(T.dimensions(F.lit("1"), F.lit(None).cast("string"), F.lit("3"))) == "1 x  x 3"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("=1", ["a"], 1), ("ok", [], -2)], "t string, l array<string>, n int")
    export.write_csv(df, str(tmp_path / "csv"), ["t", "l", "n"])
    got = sorted(tuple(r) for r in spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv")).collect())
    assert got == [("'=1", '["a"]', "1"), ("ok", "[]", "'-2")]
    export.write_jsonl(df, str(tmp_path / "json"))
    assert spark.read.text(str(tmp_path / "json")).where(F.col("value").startswith('{"l":["a"],"n":1')).count() == 1
    export.write_run(df, str(tmp_path / "t"), "r1")
    export.write_run(df, str(tmp_path / "t"), "r1")
    export.write_manifest(spark.createDataFrame([("r0",)], "run_id string"), str(tmp_path / "m"))
    stored, manifest = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "m"))
    assert stored.count() == 2 and export.read_committed(stored, manifest).count() == 0
