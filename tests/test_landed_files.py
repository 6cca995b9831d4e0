"""Files as landed: structure over splits, places and hashes of offers, against ElementTree."""

import hashlib
import random
import xml.etree.ElementTree as ET

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybridge.functions import markup
from tallybridge.operators import gates
from tallybridge.sources import feeds, structure


def _offer(rng, i):
    extra = rng.choice(["<![CDATA[ a > b <offers> ]]>", "text &gt; x > y", "<!-- <offer> - no > > -->", "<b>in</b><br/>", "<?pi a > b ?>", "", "<![CDATA[" + "> " * 80 + "]]>", "<!-- " + "<a> " * 60 + "-->"])
    return f"""<offer id="{i}" a="x > y" b='">'><name>{extra}</name><p x=">"/></offer>"""


def _feed(rng, n, shops=1, root="yml_catalog"):
    offers = "".join(_offer(rng, i) for i in range(n))
    shop = f'<shop><currencies><currency id="RUR"/></currencies><offers>{offers}</offers></shop>'
    return f'<?xml version="1.0"?>\n<!-- c > -->\n<{root} date="2031-02-28 10:00">{shop * shops}</{root}>\n'


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _paths(text):
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return None
    counts = {}

    def walk(e, above):
        path = f"{above}/{e.tag}" if above else e.tag
        if path.count("/") < structure.DEPTH:
            counts[path] = counts.get(path, 0) + 1
        for x in e:
            walk(x, path)

    walk(root, "")
    return counts


def _cases():
    rng = random.Random(8)
    good = _feed(rng, 30)
    cases = {f"f{i}.xml": _feed(rng, rng.randint(0, 60), 1 + i % 3, "html" if i == 4 else "yml_catalog") for i in range(6)}
    cases |= {"open.xml": good[:-3], "unmatched.xml": good.replace("</offers>", ""), "two_roots.xml": good + "<x/>", "empty.xml": "", "no_line_end.xml": good.rstrip(), "cut.xml": good.rstrip()[:-1], "text.xml": "hello", "crossed.xml": good.replace("<p x", "<q><p x", 1).replace("</offer>", "</offer></q>", 1), "in_comment.xml": "<a><!-- " + "<b>" * 400, "stray.xml": "<a> < </a>"}
    return cases


def test_structure_is_that_of_a_parser_however_files_are_split(spark, tmp_path, small_splits):
    cases = _cases()
    for name, text in cases.items():
        (tmp_path / name).write_text(text)
    rows = {r["file"].rsplit("/", 1)[1]: r for r in structure.file_structure(spark, str(tmp_path)).collect()}
    assert set(rows) == set(cases) and max(r["n_splits"] for r in rows.values()) > 20
    for name, text in cases.items():
        want = _paths(text)
        assert rows[name]["broken"] == (want is None), name
        assert want is None or rows[name]["counts"] == want, name
        assert rows[name]["size"] == len(text.encode())
    facts = {r["file"].rsplit("/", 1)[1]: r for r in structure.feed_facts(structure.file_structure(spark, str(tmp_path))).collect()}
    assert [facts["f2.xml"][c] for c in ("root", "shops", "offer_lists", "currency_lists", "feed_date", "head")] == ["yml_catalog", 3, 3, 3, "2031-02-28 10:00", ""]
    assert facts["f4.xml"]["root"] == "html" and facts["empty.xml"]["root"] is None and facts["empty.xml"]["broken"]


def test_declarations_and_other_encodings(spark, tmp_path):
    (tmp_path / "entity.xml").write_text('<?xml version="1.0"?><!DOCTYPE a [<!ENTITY b "c>">]><a>&b;</a>')
    (tmp_path / "cp1251.xml").write_bytes('<?xml version="1.0" encoding="windows-1251"?><a name="Имя > х"><товар>Цена</товар></a>'.encode("cp1251"))
    rows = {r["file"].rsplit("/", 1)[1]: r for r in structure.file_structure(spark, str(tmp_path)).collect()}
    assert rows["entity.xml"]["declares"] and not rows["entity.xml"]["broken"]
    assert not rows["cp1251.xml"]["declares"] and not rows["cp1251.xml"]["broken"] and sum(rows["cp1251.xml"]["counts"].values()) == 2


def test_summaries_compose_wherever_they_are_cut():
    rng = random.Random(3)
    pieces = _feed(rng, 12).encode().split(b">")
    whole = structure.Split()
    whole.read(b">".join(pieces))
    want = next(s for entry, _, s in whole.ends() if entry == "text")
    for _ in range(60):
        cuts = sorted(rng.sample(range(1, len(pieces) - 1), rng.randint(1, 6)))
        mode, seen = "text", structure.Summary()
        for a, b in zip([0, *cuts], [*cuts, len(pieces)], strict=True):
            split = structure.Split()
            for c in range(a, b, 3):
                split.read(b"".join(p + b">" for p in pieces[c : min(c + 3, b)]))
            mode, summary = next((x, s) for entry, x, s in split.ends() if entry == mode)
            seen = seen.then(structure.Summary.unpacked(summary))
        assert mode == "text" and seen.counts == structure.Summary.unpacked(want).counts and not (seen.broken or seen.opens or seen.closes)


def test_offers_have_their_place_in_files_of_many_splits(spark, tmp_path, small_splits):
    for supplier in (1, 2):
        folder = tmp_path / f"supplier={supplier}"
        folder.mkdir()
        order = list(range(80))
        random.Random(supplier).shuffle(order)
        (folder / "feed.xml").write_text('<yml_catalog date="x"><shop><offers>\n' + "\n".join(f'<offer id="{i}"><name>{"n" * (i % 37)}</name></offer>' for i in order) + "\n</offers></shop></yml_catalog>")
        rows = [r for r in feeds.read_placed(spark, str(tmp_path)).collect() if r["supplier"] == supplier]
        got = {r["position"]: int(r["fragment"].split('"')[1]) for r in rows}
        assert [got[i] for i in range(1, 81)] == order


def test_hash_does_not_see_the_order_or_quotes_of_attributes(spark):
    same = ["<offer id=\"1\" available='true'><name lang='a' x=\"b\">A &amp; B</name><p/></offer>", "<offer available=\"true\" id='1'><!-- c --><name x='b' lang='a'><![CDATA[A & B]]></name><p></p></offer>"]
    other = ['<offer id="1" available="true"><p/><name lang="a" x="b">A &amp; B</name></offer>', '<offer id="2" available="true"><name lang="a" x="b">A &amp; B</name><p/></offer>']
    broken = ["<offer id='1'><name>a</offer>", "<offer id='1'>&own;</offer>", "<offer id='1'><!ENTITY a 'b'></offer>", "<offer", "", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(same + other + broken)], "i int, x string")
    got = [r[0] for r in df.orderBy("i").select(markup.row_hash(F.col("x"))).collect()]
    assert got[0] == got[1] and len({*got[:4]}) == 3 and got[4:] == [None] * 6 and len(got[0]) == len(hashlib.sha256().hexdigest())


def test_elements_are_those_of_a_parser(spark):
    text = "<offer id=\"7\" a='&lt;x&gt;'><name>A <b>bold</b> c</name><param name='k' unit='u'>1</param><param>2</param><param name='k'>3</param><url t=\"1\">http://x/?a=1&amp;b=2</url><e/></offer>"
    got = [tuple(e) for e in spark.createDataFrame([(text,)], "x string").select(markup.elements(F.col("x"))).first()[0]]
    root, want = ET.fromstring(text), []
    want += [(f"@{k}", v) for k, v in root.attrib.items()]
    for c in root:
        key = f"param:{c.attrib.get('name') or 'unnamed'}" if c.tag == "param" else c.tag
        want.append((key, "".join(c.itertext()).strip()))
        want += [(f"{key}@{k}", v) for k, v in c.attrib.items() if c.tag != "param"]
    assert got == want


@pytest.mark.parametrize(
    ("spoil", "rule"),
    [
        (lambda t: t.replace("yml_catalog", "html"), "root_element"),
        (lambda t: t.replace("</shop>", "</shop><shop/>"), "one_shop"),
        (lambda t: t.replace("</offers>", "</offers><offers/>"), "one_offer_list"),
        (lambda t: t.replace("<currencies>", "<money>").replace("</currencies>", "</money>"), "one_currency_list"),
        (lambda t: t.replace("<offers>", "<categories/><categories/><offers>"), "at_most_one_category_list"),
        (lambda t: t.replace("<offers>", "<offers><offer/>"), "item_count"),
        (lambda t: t.replace("<offers>", "<offers>" + " " * 9000), "byte_count"),
        (lambda t: t.replace("<!-- c > -->", '<!DOCTYPE a [<!ENTITY b "c">]>'), "entity_declaration"),
        (lambda t: t.replace("2031-02-28 10:00", "2031-02-30 10:00"), "feed_date"),
        (lambda t: t.rstrip()[:-2], "well_formed"),
    ],
)
def test_each_gate_sees_its_fault_in_the_file(spark, tmp_path, spoil, rule):
    text = spoil(_feed(random.Random(2), 20))
    (tmp_path / "feed.xml").write_text(text)
    facts = structure.feed_facts(structure.file_structure(spark, str(tmp_path)))
    rows = facts.select("*", F.lit(11).alias("supplier"), F.lit("11").alias("adapter"), F.lit("yml_catalog").alias("root_wanted"), F.lit("0" * 64).alias("content_sha256"), F.lit("0" * 64).alias("source_sha256"))
    policy = spark.createDataFrame([(11, 5, 20, 9000)], "supplier int, min_items int, max_items int, max_bytes int")
    said = [r["rule"] for r in gates.snapshot_gates(rows, policy).collect()]
    assert rule in said and (rule == "root_element" or len(said) == 1 or said == ["item_count", "well_formed"])


def test_first_split_of_a_file_is_read_one_way(monkeypatch):
    """The first split of a file can only begin as text."""
    read = []
    plain = structure.Reader.read
    monkeypatch.setattr(structure.Reader, "read", lambda self, data: read.append(len(data)) or plain(self, data))
    pieces = [b"<a"] + [b"<b", b"x</b"] * 4000
    size = sum(map(len, pieces)) + len(pieces)
    names = ["file", "size", "start", "value"]
    for start, ways in ((0, 1), (500, len(structure.ENTRIES))):
        columns = [pa.array(["f"] * len(pieces)), pa.array([size] * len(pieces)), pa.array([start] * len(pieces)), pa.array(pieces, pa.binary())]
        read.clear()
        rows = [r for b in structure._reduced(iter([pa.RecordBatch.from_arrays(columns, names=names)])) for r in b.to_pylist()]
        assert sum(read) == ways * size
        assert [r["n_bytes"] for r in rows] == [size] * len(rows) and {r["entry"] for r in rows} == (set(structure.ENTRIES) if start else {"text"})
