"""Bundles, archives, property feeds and adapters on small files."""

import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from tallybridge.sources import adapters, bundle, feeds


def _tree(root):
    files = {"a.txt": b"one\ntwo\n", "deep/er/b c+d.bin": bytes(range(256)) * 40, "no_end": b"x" * 3000, "lines": b"\n" * 700, "deep/same": b"one\ntwo\n"}
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return files


@pytest.mark.parametrize("whole_bytes", [1 << 20, 100])
def test_files_are_listed_and_hashed_in_pieces_or_whole(spark, tmp_path, whole_bytes):
    files = _tree(tmp_path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = bundle.list_files(spark, str(tmp_path), whole_bytes).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["path"]: (r["sha256"], r["size"]) for r in rows} == {n: (hashlib.sha256(d).hexdigest(), len(d)) for n, d in files.items()} and len(rows) == len(files)


def test_a_seal_says_what_has_become_of_its_files(spark, tmp_path):
    _tree(tmp_path)
    bundle.seal(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)exists"):
        bundle.seal(spark, str(tmp_path))
    status = lambda: {r["path"]: r["status"] for r in bundle.check_seal(spark, str(tmp_path)).collect()}
    assert set(status().values()) == {"unchanged"} and bundle.read_seal(spark, str(tmp_path))[1].count() == 0
    (tmp_path / "a.txt").write_bytes(b"one\ntwO\n")
    (tmp_path / "lines").unlink()
    (tmp_path / "new").write_bytes(b"n")
    assert status() == {"a.txt": "changed", "lines": "missing", "new": "extra", "deep/er/b c+d.bin": "unchanged", "no_end": "unchanged", "deep/same": "unchanged"}


def test_a_spoiled_seal_and_manifest_are_told(spark, tmp_path):
    (tmp_path / "_seal").mkdir()
    (tmp_path / "_seal" / "x.json").write_text('{"version":1,"path":"a","sha256":"' + "0" * 64 + '","size":1}\n{"version":2,"path":"../b","sha256":"zz","size":-1}\n{"path":"a","sha256":"' + "0" * 64 + '","version":1,"size":1}\nno json\n')
    rules = sorted((r["path"], r["rule"]) for r in bundle.read_seal(spark, str(tmp_path))[1].collect() if r["path"])
    assert rules == [("../b", "seal_hash"), ("../b", "seal_path"), ("../b", "seal_size"), ("../b", "seal_version"), ("a", "seal_repeats")]
    h = "0" * 64
    good = ("1", f"s1-{h[:12]}-catalog-{h[:12]}-policy-{h[:12]}", "s1", {"source": ("f.xml", "inputs/source.xml", h, 3), "catalog": ("c.csv", "inputs/catalog.csv", h, 4), "config": (None, None, None, None)}, h, 0)
    rows = spark.createDataFrame([good, (*good[:1], "other", *good[2:3], {"source": good[3]["source"]}, *good[4:5], 1)], bundle.MANIFEST_SCHEMA)
    bundle.write_manifest(rows, str(tmp_path))
    back, bad = bundle.read_manifest(spark, str(tmp_path))
    assert sorted(r["rule"] for r in bad.collect()) == ["catalog_record", "production_writes", "run_id"]
    assert sorted((r["path"], r["size"]) for r in bundle.recorded_inputs(back).where(F.col("run_id") != "other").collect()) == [("inputs/catalog.csv", 4), ("inputs/source.xml", 3)]


def _zip(path, *members, **info):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members:
            z.writestr(name, data)


def test_each_bad_archive_gives_a_problem_and_no_rows(spark, tmp_path, monkeypatch):
    body = "<a><offers>" + "".join(f'<offer id="{i}"><name>ж{i}</name></offer>' for i in range(3000)) + "</offers></a>"
    _zip(tmp_path / "good.zip", ("Price.xml", body))
    _zip(tmp_path / "cp1251.zip", ("PRICE.XML", ('<?xml version="1.0" encoding="windows-1251"?>' + body).encode("cp1251")))
    _zip(tmp_path / "two.zip", ("Price.xml", body), ("b", "x"))
    _zip(tmp_path / "bomb.zip", ("Price.xml", " " * (8 << 20)))
    _zip(tmp_path / "encoding.zip", ("Price.xml", body.encode()[:-40] + b"\xff\xfe</offer>"))
    data = (tmp_path / "good.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(data[: len(data) // 2])
    (tmp_path / "none.zip").write_bytes(b"no archive")
    flagged = bytearray(data)
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        flagged[flagged.index(mark) + at] |= 1
    (tmp_path / "encrypted.zip").write_bytes(bytes(flagged))
    lying = bytearray((tmp_path / "bomb.zip").read_bytes())
    at = lying.index(b"PK\x01\x02")
    lying[at + 24 : at + 28] = (100).to_bytes(4, "little")  # the size that the header claims
    (tmp_path / "lying.zip").write_bytes(bytes(lying))
    rows = feeds.read_zipped(spark, str(tmp_path / "*.zip"), "Price.xml", max_bytes=4 << 20)
    problems = {r["source_file"].rsplit("/", 1)[1]: r["problem"] for r in rows.where("problem is not null").collect()}
    lying = problems.pop("lying.zip")
    assert lying in ("too_large", "bad_archive")
    assert problems == {"two.zip": "unexpected_members", "bomb.zip": "too_large", "encoding.zip": "bad_encoding", "cut.zip": "bad_archive", "none.zip": "bad_archive", "encrypted.zip": "encrypted"}
    kept = feeds.whole_archives(rows).groupBy(F.substring_index("source_file", "/", -1).alias("f")).agg(F.count("*").alias("n"), F.max("fragment").alias("x")).collect()
    assert {r["f"]: r["n"] for r in kept} == {"good.zip": 3000, "cp1251.zip": 3000} and all(r["x"] == '<offer id="999"><name>ж999</name></offer>' for r in kept)


def test_property_feed_faults_by_rule(spark, tmp_path):
    body = """<xml_catalog date="2031-03-07 08:15"><properties><property id="p1">Цвет</property><property id="p2"></property><property id="p1">again</property><property id="q">x</property></properties>
<items><item id="7"><p1>белый</p1><p1>красный</p1></item><item id="8"><p9>1</p9><b>2</b></item><item id="7"></item><item id="08"></item><item id="9"><p1>a<p1></item></items></xml_catalog>"""
    (tmp_path / "p.xml").write_bytes(body.encode("windows-1251"))
    rows = lambda **k: sorted((r["rule"], r["row_key"]) for r in feeds.property_rejects(spark, str(tmp_path / "p.xml"), **k).collect())
    known = [("item_id", None), ("property_id", "x"), ("property_name", "p2"), ("property_tag", "8"), ("repeated_definition", "p1"), ("repeated_item", "7"), ("repeated_property", "7"), ("unparsable_item", "9")]
    assert rows(allow_unknown=True) == known
    assert rows() == sorted([*known, ("unknown_property", "8/p9")])
    (tmp_path / "p.xml").write_bytes(body.encode("windows-1251").replace("белый".encode("cp1251"), b"\x98"))
    assert ("bad_encoding", "item") in rows()


def test_adapters_fail_closed(spark, tmp_path):
    kind = "supplier long, adapter string, prefix string, root string"
    registry = spark.createDataFrame([(1, "11", "11", "yml_catalog"), (2, "31", "31", "xml_catalog"), (3, "99", "99", "x"), (4, "41", "11", "yml_catalog"), (5, None, None, None), (6, "31", "31", "yml_catalog"), (7, "41", "41", "yml_catalog"), (8, "11", "11", "yml_catalog"), (8, "41", "41", "yml_catalog")], kind)
    for s in range(1, 9):
        (tmp_path / f"supplier={s}").mkdir()
        (tmp_path / f"supplier={s}" / "f.xml").write_text(f'<c><offer id="{s}" available="yes"><price>5</price><priceE>7</priceE><name>n</name><quantity>2</quantity></offer></c>')
    offers, bad = adapters.read(spark, registry, str(tmp_path))
    assert sorted((r["supplier"], r["catalog_sku"], int(r["source_price"]), r["quantity"]) for r in offers.collect()) == [(1, "111", 5, None), (2, "312", 7, None), (7, "417", 5, 2)]
    assert sorted((r["supplier"], r["rule"]) for r in bad.collect()) == [(3, "unknown_adapter"), (4, "adapter_prefix"), (5, "unknown_adapter"), (6, "adapter_root"), (8, "adapter_twice")]


def test_adapters_by_their_own_folders(spark, tmp_path):
    """Each dialect lists its own folder alone; a feed under another adapter than its supplier's is not read, a dialect may have no feed."""
    registry = spark.createDataFrame([(1, "11", "11", "yml_catalog"), (2, "31", "31", "xml_catalog"), (3, "11", "11", "yml_catalog"), (4, "41", "41", "yml_catalog")], "supplier long, adapter string, prefix string, root string")
    for adapter, s in (("11", 1), ("31", 2), ("31", 3)):
        folder = tmp_path / f"adapter={adapter}" / f"supplier={s}"
        folder.mkdir(parents=True)
        (folder / "f.xml").write_text(f'<c><offer id="{s}" available="yes"><price>5</price><priceE>7</priceE><name>n</name></offer></c>')
    offers, bad = adapters.read(spark, registry, str(tmp_path), by_adapter=True)
    assert sorted((r["supplier"], r["catalog_sku"]) for r in offers.collect()) == [(1, "111"), (2, "312")] and bad.isEmpty()
    listed = {f.split("/adapter=")[1][:2] for f in offers.inputFiles()}
    assert listed == {"11", "31"} and len(offers.inputFiles()) == 3
