"""What a bucket of the missing state and its rows take, and that they are read back as they were."""

import json
import random

import pandas as pd
from pyspark.sql import functions as F

from tallybridge.streaming import keyed_missing


class _State:
    def __init__(self, held=None):
        self.held, self.exists = held, held is not None

    @property
    def get(self):
        return self.held

    def update(self, held):
        self.held, self.exists = held, True


def _rows(products, place, sku=None):
    return pd.DataFrame([(s, s * 1_000_000 + p, sku, 100 + place, place, 1) for s, p in products], columns=["supplier", "product_id", "sku", "run", "place", "first"])


def test_state_of_a_bucket_is_read_back_and_small():
    products = [(i * 7919 % 1000 - 3, i * 104729 % 20000) for i in range(4000)]
    state = _State()
    first = pd.concat(keyed_missing.count_missing((0,), iter([_rows(products, 24)]), state))
    again = pd.concat(keyed_missing.count_missing((0,), iter([_rows(products[:10], 30, "own")]), state))
    assert len(first) == 4000 and set(first["streak"]) == {24} and set(again["streak"]) == {30} and set(again["sku"]) == {"own"}
    held = keyed_missing._unpacked(state.held[0])
    assert {tuple(r[:2]): tuple(r[2:]) for r in held[["supplier", "product_id", *keyed_missing.CHANGED_NAMES[2:]]].itertuples(index=False)} == {(s, s * 1_000_000 + p): ("own", 30, 30, 130, 0) if i < 10 else (None, 24, 24, 124, 0) for i, (s, p) in enumerate(products)}
    assert len(state.held[0]) < len(json.dumps({f"{r.supplier} {r.product_id}": list(r[3:]) for r in held.itertuples()})) / 4
    assert not len(keyed_missing._unpacked(keyed_missing._packed(held[:0])))


def test_a_sku_made_of_the_key_is_not_carried(spark):
    runs = spark.createDataFrame([(10, 1), (20, 2)], "run long, place int")
    at = spark.createDataFrame([(1, 7, [1]), (1, 8, [])], "supplier long, product_id long, at array<int>")
    rows = keyed_missing.absences(at, runs, 1, 2)
    assert rows.where("sku is not null").count() == 0 and rows.count() == 2
    changed = spark.createDataFrame([(1, 7, None, 1, 2, 20, 1, 1), (1, 8, "own", 2, 2, 20, 0, 1)], f"{keyed_missing.CHANGED}, version int")
    assert {r["product_id"]: r["sku"] for r in keyed_missing.current(changed, runs).collect()} == {7: "1-7", 8: "own"}
    assert keyed_missing.current(changed.where(F.lit(False)), runs).count() == 0


def test_rows_of_a_bucket_are_counted_as_one_by_one():
    rng = random.Random(4)
    state, want = _State(), {}
    for _ in range(60):
        places = [(rng.randint(1, 3), rng.randint(1, 6), rng.randint(1, 40), rng.randint(0, 4)) for _ in range(rng.randint(1, 12))]
        rows = pd.DataFrame([(s, p, f"{s}-{p}", 10 * at, at, max(1, at - back)) for s, p, at, back in places], columns=["supplier", "product_id", "sku", "run", "place", "first"])
        changed = set()
        for r in sorted(rows.itertuples(index=False), key=lambda r: (r.place, r.supplier, r.product_id, r.first)):
            _, streak, last, _, seen = want.get(r[:2], (None, 0, 0, 0, 0))
            if r.place > last:
                first = max(r.first, last + 1)
                if last and first > last + 1:
                    streak, seen = 0, first - 1
                want[r[:2]] = (r.sku, streak + r.place - first + 1, r.place, r.run, seen)
                changed.add(r[:2])
        told = list(keyed_missing.count_missing((0,), iter([rows[:3], rows[3:]]), state))
        got = [tuple(r) for pdf in told for r in pdf.itertuples(index=False)]
        assert got == [(*k, *want[k]) for k in sorted(changed)]
