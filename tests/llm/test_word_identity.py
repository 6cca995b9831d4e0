"""Words, sets and windows are told apart by what they are; hot signatures and classes in pieces."""

import numpy as np
import pytest

from tallybridge.llm import kernels, ngram_join, substrings
from tests.llm.test_text_operators import SCHEMA, brute_components, docs, rows  # noqa: F401


def mirrored(n_doublings: int = 10) -> tuple[str, str]:
    """A sequence and its complement that polynomials modulo a power of two cannot tell apart."""
    bits = [0]
    for _ in range(n_doublings):
        bits += [1 - x for x in bits]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_long_words_of_equal_structure_are_not_linked(spark):
    a, b = mirrored()
    some = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in ngram_join.similar_components(some).collect()} == {(1, 1), (2, 2)}


def test_long_words_of_equal_structure_are_not_removed(spark):
    a, b = mirrored()
    some = spark.createDataFrame([(1, " ".join([a] * 13)), (2, " ".join([b] * 13)), (3, " ".join([a] * 14))], "doc_id long, text string")
    assert {(r["doc_id"], r["n_removed"]) for r in substrings.remove_repeats(some).collect()} == {(1, 0), (2, 0), (3, 14)}


def test_fingerprints_that_agree_do_not_link(monkeypatch, spark):
    """A verified pair is similar by its words, whatever the hashes say."""
    texts = [" ".join(f"{x}{i}" for i in range(40)) for x in "ab"]
    batch = [kernels.words(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]), True) for t in texts]
    assert len({ngram_join._set_id(next(kernels.document_sets(w, 4))) for w in batch}) == 2
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "document_sets", lambda w, k: iter([np.arange(37, dtype=np.uint64)] * (len(w.first) - 1)))
    pairs = pa.RecordBatch.from_pydict({"a": [1, 2], "b": [3, 4], "x": [texts[0].encode(), texts[1].encode()], "y": [texts[1].encode(), texts[1].encode()]})
    (kept,) = ngram_join._verify(4, 85)(iter([pairs]))
    assert kept.column(0).to_pylist() == [2]


@pytest.mark.parametrize("sizes", [{"SAMPLE": 1, "FREQUENT": 2, "UNIT_ROWS": 2, "PACK_ROWS": 3}, {"BROADCAST_IDS": 0, "LARGE_CLASS": 10**9}])
def test_pieces_and_shuffles_give_the_same(monkeypatch, spark, docs, rows, sizes):  # noqa: F811
    for name, value in sizes.items():
        monkeypatch.setattr(ngram_join, name, value)
    base = rows[6][1]
    more = rows + [(1000 + i, base, "en", "s", 0, "", "", "") for i in range(70)]
    table = spark.createDataFrame(more, SCHEMA).repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(table).collect()}
    assert got == brute_components(more, 4, 85)


@pytest.mark.parametrize("rate", [0.0, 0.5, 0.9])
def test_any_allocation_finds_similar_pairs(rate):
    rng = np.random.default_rng(9)
    for n in (5, 40, 150, 600):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.append(a[: -max(1, n // 12)], rng.integers(0, 1 << 62, n // 15).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            sign, of = ngram_join.signatures([a, b], 80, np.zeros(0, np.uint64), rate)
            assert set(sign[of == 0].tolist()) & set(sign[of == 1].tolist())


def test_open_groups_pass_on_fewer_links_than_members(monkeypatch):
    """Near copies that no link joins yet, and texts that are alike by their counts only: rows are members or links, never pairs."""
    import pyarrow as pa

    base = [f"w{i}" for i in range(200)]
    near = [" ".join([*base[:k], f"x{k}", *base[k + 1 :]]).encode() for k in range(2, 122)]
    other = [" ".join(f"{k}y{i}" for i in range(40)).encode() for k in range(30)]
    folded, n = near + other, len(near) + len(other)
    sets = ngram_join._sets_of(folded, 4)
    here = {"node": np.arange(n), "part": np.arange(n), "size": np.array([len(x) for x in sets]), "low": [True] * n, "high": [True] * n}
    twice = pa.concat_tables([pa.table({"unit": [u] * n, "deal": [0] * n, **here, "profile": pa.array([ngram_join._profile(x) for x in sets], pa.binary())}) for u in (1, 2)])
    left = ngram_join._undecided(85)(twice)
    assert set(range(len(near))) <= set(left.column("node").to_pylist()) and left.num_rows <= twice.num_rows
    asked, judged = sorted(set(left.column("node").to_pylist())), []
    similar = ngram_join._similar
    monkeypatch.setattr(ngram_join, "_similar", lambda *a: lambda *x: judged.append(1) or similar(*a)(*x))
    links = ngram_join._linked(4, 85)(left, pa.table({"node": asked, "folded": [folded[i] for i in asked]}))
    assert links.num_rows == len(near) - 1 and len(judged) < n * n // 4
    assert {*links.column("a").to_pylist(), *links.column("b").to_pylist()} == set(range(len(near)))


def test_groups_alone_connect_near_copies(monkeypatch, spark):
    """What the first members of the groups would join is left to the comparison inside the groups."""
    monkeypatch.setattr(ngram_join, "_checked", lambda pairs, *_: pairs.where("false"))
    monkeypatch.setattr(ngram_join, "UNIT_ROWS", 4)
    some = []
    for c in range(3):
        base = [f"{c}w{i}" for i in range(200)]
        some += [(10 * c + k, " ".join([*base[: 20 * k + 3], f"x{c}{k}", *base[20 * k + 4 :]])) for k in range(9)]
    table = spark.createDataFrame(some, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_components(table).collect()}
    assert got == brute_components(some, 4, 85)
