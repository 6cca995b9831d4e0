"""Missing-product state kept by key, against a plain loop, with restarts and replays."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybridge.operators import missing
from tallybridge.plans import catalogue
from tallybridge.streaming import keyed_missing

KIND = "supplier long, product_id long, sku string, run long, place long"


def _stepped(rows, runs):
    """The state by going through every run."""
    state = {}
    for run, place in runs:
        gone = {(s, p): k for s, p, k, r, _ in rows if r == run}
        for key in {*state, *gone}:
            sku, n, seen, last = state.get(key, (None, 0, None, None))
            state[key] = (gone[key], n + 1, seen, run) if key in gone else (sku, 0, run, last)
    return {(s, p, *v) for (s, p), v in state.items()}


def test_keyed_state_equals_a_walk_through_the_runs(spark, tmp_path):
    rng = random.Random(5)
    runs = [(10 * i + 3, i) for i in range(1, 13)]
    rows = [(s, p, f"{s}-{p}", run, place) for run, place in runs for s in (1, 2) for p in range(40) if rng.random() < (0.2 + 0.6 * (p % 3 == 0))]
    landed, state, checkpoint = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")
    table = spark.createDataFrame(runs, "run long, place long")
    written = []
    for a, b in ((0, 5), (5, 9), (9, 12)):
        part = [r for r in rows if a < r[4] <= b]
        spark.createDataFrame(part, KIND).write.mode("append").parquet(landed)
        if b == 9:  # a file that is landed once more changes nothing
            spark.createDataFrame(part, KIND).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(KIND).parquet(landed)
        keyed_missing.run(stream, state, checkpoint).awaitTermination()
        changed = keyed_missing.changes(spark, state)
        got = {tuple(r) for r in keyed_missing.current(changed, table.where(F.col("place") <= b)).collect()}
        assert got == _stepped([r for r in rows if r[4] <= b], runs[:b])
        written.append(changed.count() - sum(written))
    # What is written follows the products that were missing in the part.
    assert written == [len({r[:2] for r in rows if a < r[4] <= b}) for a, b in ((0, 5), (5, 9), (9, 12))]


def test_current_state_gives_actions(spark):
    changed = spark.createDataFrame([(1, 7, "1-7", 3, 4, 40, 0, 1), (1, 8, "1-8", 1, 2, 20, 0, 1)], f"{keyed_missing.CHANGED}, version int")
    runs = spark.createDataFrame([(10 * i, i) for i in range(1, 5)], "run long, place long")
    state = keyed_missing.current(changed, runs)
    assert [f.name for f in state.schema] == [c.split()[0] for c in missing.STATE.split(", ")]
    done = spark.createDataFrame([(1, 40, True)], "supplier long, run long, complete boolean")
    policy = spark.createDataFrame([(1, "hide", 3)], "supplier long, action string, threshold int")
    assert [tuple(r) for r in missing.actions(state, done, policy).collect()] == [(1, "hide", 7, "1-7", 3)]
    assert {tuple(r) for r in state.collect()} == {(1, 7, "1-7", 3, None, 40), (1, 8, "1-8", 0, 40, 20)}


@pytest.mark.parametrize("rows", [[], [(1, 1, "a", 5, 1)]])
def test_nothing_and_one(spark, tmp_path, rows):
    spark.createDataFrame(rows, KIND).write.parquet(str(tmp_path / "in"))
    keyed_missing.run(spark.readStream.schema(KIND).parquet(str(tmp_path / "in")), str(tmp_path / "s"), str(tmp_path / "cp")).awaitTermination()
    assert keyed_missing.changes(spark, str(tmp_path / "s")).count() == len(rows)


def test_stretches_of_absence_give_the_state_of_a_walk(spark, tmp_path):
    rng = random.Random(8)
    runs = [(10 * i + 3, i) for i in range(1, 13)]
    seen = {p: sorted(i for _, i in runs if rng.random() < rng.choice([0.1, 0.5, 0.95])) for p in range(60)} | {60: [], 61: list(range(1, 13))}
    table, at = spark.createDataFrame(runs, "run long, place int"), spark.createDataFrame([(1, p, a) for p, a in seen.items()], "supplier long, product_id long, at array<int>")
    landed, state, checkpoint = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "cp")
    for low, high in ((1, 5), (6, 9), (6, 9), (10, 12)):  # a part that lands twice changes nothing
        part = keyed_missing.absences(at, table, low, high)
        assert part.count() <= sum(len([i for i in a if low <= i <= high]) + 1 for a in seen.values())
        part.write.mode("append").parquet(landed)
        keyed_missing.run(spark.readStream.schema(part.schema).parquet(landed), state, checkpoint).awaitTermination()
    got = {tuple(r) for r in keyed_missing.current(keyed_missing.changes(spark, state), table).collect()}
    assert got == _stepped([(1, p, f"1-{p}", run, i) for p, a in seen.items() for run, i in runs if i not in a], runs)


def test_what_the_query_lands_follows_the_sightings(spark, sf):
    folder = Path(catalogue.fresh_folder(spark, "any")).parent
    before = set(folder.glob("*"))
    catalogue.missing_keyed_stream(spark, sf)
    seen = catalogue.views.seen(spark, sf)
    n_seen, n_products = seen.count(), seen.select("supplier", "product_id").distinct().count()
    (made,) = [f for f in set(folder.glob("*")) - before if f.name.startswith("missing-keyed")]
    landed = sum(spark.read.parquet(str(f)).count() for f in {p.parent for p in made.glob("**/*.parquet") if "state" not in p.parts})
    assert 0 < landed <= n_seen + 3 * n_products
