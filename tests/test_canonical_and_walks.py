"""Canonical JSON of nested types, walks by doubled steps, completeness as decimals."""

from decimal import Decimal

from pyspark.sql import functions as F

from tallybridge.functions.canonical import canonical_row
from tallybridge.operators import audit, categories, summary
from tallybridge.sinks import export

KIND = "b struct<y:int,x:map<string,array<struct<q:int,p:map<string,int>>>>>, a map<int,struct<d:int,c:string>>"


def test_maps_in_other_order_give_the_same_digest(spark):
    one = [((1, {"k": [(1, {"u": 1, "t": None})], "j": []}), {2: (5, "z"), 1: None}), (None, None)]
    two = [((1, {"j": [], "k": [(1, {"t": None, "u": 1})]}), {1: None, 2: (5, "z")}), (None, None)]
    other = [((1, {"j": [], "k": [(1, {"t": 2, "u": 1})]}), {1: None, 2: (5, "z")}), (None, None)]
    digests = [audit.table_digest(spark.createDataFrame(rows, KIND)).first()["digest"] for rows in (one, two, other)]
    assert digests[0] == digests[1] != digests[2]
    df = spark.createDataFrame(one, KIND)
    assert df.select(canonical_row(df).alias("x")).first()["x"] == '{"a":{"1":null,"2":{"c":"z","d":5}},"b":{"x":{"j":[],"k":[{"p":{"t":null,"u":1},"q":1}]},"y":1}}'


def test_nested_cells_are_canonical(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2},), ({"a": 2, "b": 1},)], "m map<string,int>")
    assert {r["m"] for r in export.csv_cells(df, ["m"]).collect()} == {'{"a":2,"b":1}'}


def test_a_chain_of_1000_levels_takes_a_round_for_each_doubling(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(categories, "checkpointed", lambda df: rounds.append(1) or df.checkpoint())
    spark.sparkContext.setCheckpointDir("/tmp/spark-checkpoints") if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty() else None
    rows = [(f"c{i}", f"n{i}", f"c{i - 1}" if i else None) for i in range(1000)] + [("x", "x", "y"), ("y", "y", "z"), ("z", "z", "y"), ("u", "u", "nowhere"), ("v", "v", "u")]
    walked = categories.paths(spark.createDataFrame(rows, "id string, name string, parent_id string").coalesce(1))
    got = {r["id"]: (r["path"], r["broken"]) for r in walked.collect()}
    assert all(got[f"c{i}"] == ([f"n{j}" for j in range(i + 1)], None) for i in range(1000))
    assert {k: got[k] for k in "xyzuv"} == {"x": (["x"], "cycle"), "y": (["y"], "cycle"), "z": (["z"], "cycle"), "u": (["u"], "unknown_parent"), "v": (["u", "v"], "unknown_parent")}
    assert len(rounds) <= 2 + 2 * 11
    every = {tuple(r) for r in categories.path_rejects(walked).collect()}
    assert every == {("x", "category_cycle"), ("y", "category_cycle"), ("z", "category_cycle"), ("u", "unknown_parent"), ("v", "unknown_parent")}
    used = spark.createDataFrame([("c5",), ("v",), ("v",)], "id string")
    assert {tuple(r) for r in categories.path_rejects(walked, used).collect()} == {("v", "unknown_parent")}


def test_no_categories(spark):
    assert categories.paths(spark.createDataFrame([], "id string, name string, parent_id string")).count() == 0


def test_completeness_says_why_in_decimals(spark):
    offers = spark.createDataFrame([(1, ["u"]), (1, []), (2, None)], "supplier int, image_urls array<string>").select("*", *[F.lit("x").alias(c) for c in ("ean", "mpn", "manufacturer")])
    catalog = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (3, 1)], "supplier int, product_id int")
    missing = catalog.where("supplier = 1 and product_id = 3")
    rows = {r["supplier"]: r for r in summary.completeness(offers, catalog, missing).collect()}
    assert rows[1]["source_ratio"].quantize(Decimal("1e-6")) == Decimal("0.666667") and rows[1]["reason"] == "source_does_not_cover_catalog_scope"
    assert rows[3]["source_ratio"] == 0 and rows[2]["covered_ratio"] == 1 and rows[2]["reason"] == "all_catalog_scope_items_seen"
    assert {r["supplier"]: r["with_image"] for r in summary.identity_coverage(offers).collect()} == {1: 1, 2: 0}
