"""Category chains deeper than any fixed limit."""

from tallybridge.operators import categories


def test_a_sound_chain_of_40_levels_is_no_cycle(spark):
    rows = [(f"c{i}", f"n{i}", f"c{i - 1}" if i else None) for i in range(40)] + [("x", "x", "y"), ("y", "y", "x")]
    got = {r["id"]: r for r in categories.paths(spark.createDataFrame(rows, "id string, name string, parent_id string").coalesce(1)).collect()}
    assert len(got) == 42 and got["c39"]["broken"] is None and list(got["c39"]["path"]) == [f"n{i}" for i in range(40)]
    assert got["x"]["broken"] == got["y"]["broken"] == "cycle"
