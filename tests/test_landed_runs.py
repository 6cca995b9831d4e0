"""Feeds that land: written and read whole, hashed against what was sent, and no gate left out of a run."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallybridge.functions import elements, markup
from tallybridge.plans import landed
from tallybridge.sinks import feed_files
from tallybridge.sources import feeds, files, structure
from tallybridge.streaming import landed_feeds

FRAGMENTS = [
    "<offer id=\"1\" available='true'><name lang='a' x=\"b\">A &amp; B</name><p/></offer>",
    "<offer available=\"true\" id='1'><!-- c --><name x='b' lang='a'><![CDATA[A & <B>]]></name><p></p></offer>",
    "<offer id='2'>  <a> x &amp;lt; &#65;&#x42;&apos;  </a>\n<a> y \"q\" \\u00ab \t z</a><b k='&quot;&#10;'>1 <i>in</i> <u/> > 2</b> text </offer>",
    "<offer id='3'><a>1</a > <b:c d.e=\"x > y\"/>\x0b\x1f&#31;</offer>",
    "<offer id='3'><a>\x1f &#31;   \U0001f600</a></offer>",
    "<offer  id = '4' ><a><a>in itself</a></a></offer>",
    "<offer id='5'><a>&own;</a></offer>",
    "<offer id='6'><a>open</offer>",
    "<offer id='7'><!ENTITY a 'b'></offer>",
    "<offer id='8'>a < b</offer>",
    "<offer id='9'><a>x</a>&<b>y</b></offer>",
    "<offer/>",
    "<offer>only text &gt;</offer>",
    "<offer id='10' id='11'><a x='2' x='1'>&amp;#65; &#0065;&#65;</a></offer>",
    "<offer><a>1</a><b>2</c></offer>",
    "<offer",
    "",
    None,
]


def test_hash_in_tasks_is_that_of_the_columns(spark):
    rows = spark.createDataFrame([(i, i, x) for i, x in enumerate(FRAGMENTS)], "supplier int, position long, fragment string")
    want = {r[0]: tuple(r)[1:] for r in rows.select("supplier", F.get(F.filter(markup.parsed(F.col("fragment"))["attributes"], lambda a: a["name"] == "id"), F.lit(0))["value"], markup.row_hash(F.col("fragment"))).collect()}
    got = {r[0]: tuple(r)[2:] for r in elements.hashed(rows).collect()}
    assert got == want and sum(h is None for _, h in got.values()) > 5


def _feed(n, inner=""):
    offers = "".join(f'<offer id="{i}"><name>{inner} n &gt; {i}</name></offer>\n' for i in range(n))
    return f'<?xml version="1.0"?>\n<yml_catalog date="2031-02-28 10:00"><shop>\n<offers>\n{offers}</offers></shop></yml_catalog>\n'


@pytest.fixture
def landed_folder(tmp_path):
    for supplier, text in {1: _feed(30), 2: _feed(3), 3: _feed(0), 4: _feed(5)[:-4], 5: _feed(5).rstrip(), 6: "", 7: "text"}.items():
        (tmp_path / f"files-{supplier % 2}").mkdir(exist_ok=True)
        (tmp_path / f"files-{supplier % 2}" / f"supplier={supplier}.xml").write_text(text)
    (tmp_path / "_hidden.xml").write_text("")
    return str(tmp_path)


def test_whole_files_and_files_in_pieces_are_told_alike(spark, landed_folder):
    def told():
        found = files.list_files(spark, landed_folder)
        facts = {tuple(str(x) for x in r) for r in structure.file_structure(spark, found).drop("n_splits").collect()}
        placed = {tuple(r) for r in feeds.read_placed(spark, found).select("source_file", "position", "fragment").collect()}
        return found, {(f.rsplit("/", 1)[1], *more) for f, *more in facts}, {(f.rsplit("/", 1)[1], *more) for f, *more in placed}

    whole, facts, placed = told()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        split, other_facts, other_placed = told()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert not whole.large and len(split.large) == 3 and [len(f.empty) for f in (whole, split)] == [1, 1]
    assert facts == other_facts and len(facts) == 7 and placed == other_placed and len(placed) == 43
    by_name = {f[0]: f for f in facts}
    assert by_name["supplier=1.xml"][-1] == hashlib.sha256(_feed(30).encode()).hexdigest()


def test_whole_files_are_counted_without_a_shuffle(spark, landed_folder):
    found = structure.file_structure(spark, files.list_files(spark, landed_folder))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_offers_hashed_in_files_are_those_that_are_placed(spark, landed_folder):
    found = files.list_files(spark, landed_folder)
    in_files = elements.hashed_in_files(found.whole.select("file", "content")).collect()
    placed = elements.hashed(feeds.read_placed(spark, found).select(F.col("source_file").alias("file"), "position", "fragment")).collect()
    assert {tuple(r) for r in in_files} == {tuple(r) for r in placed} and len(placed) == 43


def _lines(spark, feeds_of):
    rows = [(s, i, line) for s, text in feeds_of.items() for i, line in enumerate(text.splitlines())]
    return spark.createDataFrame(rows, "supplier long, i int, line string").repartition(3, "supplier").sortWithinPartitions("supplier", "i").select("supplier", "line")


def test_written_feeds_are_whole_and_their_hashes_known(spark, tmp_path):
    sent = {s: _feed(s * 7, "é") for s in range(1, 90)}
    for _ in range(2):  # a task that is done again leaves the same
        told = {r["supplier"]: r["sha256"] for r in feed_files.write_feeds(_lines(spark, sent), f"{tmp_path}/out").collect()}
    found = {p.name: p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {f"supplier={s}.xml": text.encode() for s, text in sent.items()}
    assert told == {s: hashlib.sha256(text.encode()).hexdigest() for s, text in sent.items()}


def test_a_file_that_is_not_what_was_sent_is_rejected(spark, sf, tmp_path):
    sent = feed_files.write_feeds(_lines(spark, {2: _feed(3), 4: _feed(3)}), f"{tmp_path}/out")
    path = next((tmp_path / "out").rglob("supplier=4.xml"))
    path.write_text(path.read_text().replace(" n ", " m "))
    bad = landed._gate_rejects(spark, sf, files.list_files(spark, f"{tmp_path}/out"), sent).where("rule = 'content_hash_equal'")
    assert [r["supplier"] for r in bad.collect()] == [4]


def test_no_supplier_that_a_gate_rejects_is_in_the_run(spark, sf):
    sf = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.01")
    bad = {r["supplier"] for r in landed.landed_gates(spark, sf).select("supplier").distinct().collect()}
    run = {r["supplier"] for r in landed.landed_run(spark, sf).select("supplier").distinct().collect()}
    assert run and not run & bad


def test_stream_leaves_the_session_as_it_was(spark, landed_folder, tmp_path_factory):
    before, out = spark.conf.get(landed_feeds._LISTING), str(tmp_path_factory.mktemp("stream"))
    seen = []

    def judge(session, found):
        seen.append((sorted(r["file"][-5] for r in found.whole.select("file").collect()), len(found.large), session.conf.get(landed_feeds._LISTING)))
        rows = found.whole.select(F.lit(1).alias("supplier"), "file")
        return rows, rows.where("false").select("supplier", F.lit("r").alias("rule"))

    for _ in range(2):
        landed_feeds.run(landed_feeds.feed_stream(spark, landed_folder, 4), judge, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    assert spark.conf.get(landed_feeds._LISTING) == before and all(int(n) < int(before) for *_, n in seen)
    assert sorted(sum((names for names, *_ in seen), [])) == ["1", "2", "3", "4", "5", "7"] and len(seen) == 2
    assert landed_feeds.table(spark, f"{out}/table", "rows").count() == 6
