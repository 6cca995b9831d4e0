"""Null languages and ids, repeats and odd names in the maintained token totals, against brute force."""

import collections
import random

import pytest

from tallybridge.llm import token_counts

KIND = "change string, doc_id long, source string, lang string, tokenizer string, n_tokens long"


def test_null_lang_is_revised_and_null_ids_stay(spark, tmp_path):
    rows = [(1, "a", "en", "x", 5), (2, "a", None, "y", 7), (3, "a", None, "y", 7), (None, "b", None, "z", 4), (None, "b", None, "w", 4), (None, "b", None, "v", 6)]
    counted = spark.createDataFrame(rows, "doc_id long, source string, lang string, copy string, n_tokens long")
    got = {tuple(r) for r in token_counts.maintained_totals(spark, counted, str(tmp_path / "r"), "t").collect()}
    assert got == {("a", "en", "t+end", 1, 6), ("a", None, "t", 1, 8), ("b", None, "t", 3, 14)}


def brute(batches):
    held, nameless, seen = {}, collections.Counter(), set()
    for name, rows in batches:
        if name in seen:
            continue
        seen.add(name)
        for key in {(r[1], r[4]) for r in rows if r[1] is not None and r[0] in ("insert", "delete", "revise")}:
            held[key] = []
        for r in set(r[1:] for r in rows if r[1] is not None and r[0] in ("insert", "revise")):
            held[r[0], r[3]].append(r)
        for r in rows:
            if r[1] is None and r[0] == "insert":
                nameless[r[2:]] += 1
    out = collections.defaultdict(lambda: [0, 0])
    for rows in held.values():
        for _, source, lang, tok, n in rows:
            out[source, lang, tok][0] += 1
            out[source, lang, tok][1] += n or 0
    for (source, lang, tok, n), k in nameless.items():
        out[source, lang, tok][0] += k
        out[source, lang, tok][1] += k * (n or 0)
    return {k: tuple(v) for k, v in out.items() if any(v)}


@pytest.mark.parametrize("compact_after", [32, 1])
def test_random_batches(spark, tmp_path, compact_after):
    rng = random.Random(compact_after)
    pick = lambda *x: rng.choice(x)
    row = lambda: (pick("insert", "insert", "delete", "revise", "other", None), pick(None, *range(8)), pick("a", "b"), pick("en", None, "de"), pick("t", "u/1=2", None), pick(None, 1, 5, 9))
    batches = [(f"day/{i % 3}=x y%20", [row() for _ in range(12)]) for i in range(4)]
    batches[1] = (batches[1][0], batches[1][1] + batches[1][1][:3])
    rollup = token_counts.Rollup(spark, str(tmp_path / "r"), n_buckets=3, compact_after=compact_after)
    for i, (name, rows) in enumerate(batches):
        assert rollup.apply(name, spark.createDataFrame(rows, KIND)) == (i < 3)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()} == brute(batches)
    assert compact_after > 1 or len(rollup.folders()) == 1


def test_of_two_writers_of_a_batch_one_counts(spark, tmp_path, monkeypatch):
    one, two = (token_counts.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    batch = spark.createDataFrame([("insert", 1, "a", "en", "t", 3)], KIND)
    write = one._write

    def late(folder, signed):
        write(folder, signed)
        assert two.apply("b", batch)

    monkeypatch.setattr(one, "_write", late)
    assert not one.apply("b", batch)
    assert [tuple(r) for r in two.totals().collect()] == [("a", "en", "t", 1, 3)]


@pytest.mark.parametrize("large", [10_000, 1])
def test_copies_are_marked_alike_by_broadcast_and_shuffle(spark, monkeypatch, large):
    monkeypatch.setattr(token_counts, "LARGE_GROUP", large)
    rows = [(i, "hot" if i % 2 else f"t{i % 7}") for i in range(300)] + [(None, "hot"), (3, "hot"), (9000, None)]
    first = {}
    for i, c in sorted((r for r in rows if r[0] is not None)):
        first.setdefault(c, i)
    got = {(r["doc_id"], r["copy"]): r["is_copy"] for r in token_counts.marked_copies(spark.createDataFrame(rows, "doc_id long, copy string")).collect()}
    assert got == {(i, c): None if i is None else i > first[c] if c else False for i, c in rows}


def _inserted(spark, *ids):
    return spark.createDataFrame([("insert", i, "a", "en", "t", 5) for i in ids], KIND)


def test_overlapping_compactions_count_once(spark, tmp_path, monkeypatch):
    one, two = (token_counts.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    for i in range(3):
        assert one.apply(f"b{i}", _inserted(spark, i))
    write, done = one._write, []

    def late(folder, signed):
        write(folder, signed)
        if not done:  # while this compaction is under way another batch and another compaction are committed
            done.append(two.apply("b3", _inserted(spark, 3)))
            done.append(two.compact())

    monkeypatch.setattr(one, "_write", late)
    one.compact()
    assert done == [True, True]
    assert [tuple(r) for r in two.totals().collect()] == [("a", "en", "t", 4, 20)]
    assert two.apply("b4", spark.createDataFrame([("delete", i, None, None, "t", None) for i in range(4)], KIND)) and two.totals().count() == 0


def test_a_batch_worked_out_before_another_of_the_same_documents_is_worked_out_anew(spark, tmp_path, monkeypatch):
    one, two = (token_counts.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    one.apply("b0", _inserted(spark, 1))
    revise = lambda n: spark.createDataFrame([("revise", 1, "a", "en", "t", n)], KIND)
    write, done = one._write, []

    def late(folder, signed):
        write(folder, signed)
        if not done:
            done.append(two.apply("b1", revise(7)))

    monkeypatch.setattr(one, "_write", late)
    assert one.apply("b2", revise(9)) and done == [True]
    assert [tuple(r) for r in one.totals().collect()] == [("a", "en", "t", 1, 9)]


def test_a_compaction_in_between_lets_a_batch_stand(spark, tmp_path, monkeypatch):
    one, two = (token_counts.Rollup(spark, str(tmp_path / "r")) for _ in range(2))
    for i in range(2):
        one.apply(f"b{i}", _inserted(spark, i))
    write, done = one._write, []

    def late(folder, signed):
        write(folder, signed)
        done.append(two.compact())

    monkeypatch.setattr(one, "_write", late)
    assert one.apply("b2", _inserted(spark, 1, 2)) and done == [True]
    assert [tuple(r) for r in one.totals().collect()] == [("a", "en", "t", 3, 15)]


def test_a_writer_lost_before_its_version_leaves_the_batch_to_the_next(spark, tmp_path, monkeypatch):
    rollup = token_counts.Rollup(spark, str(tmp_path / "r"))

    def lost(name, content):
        (tmp_path / "r" / "_log").mkdir(parents=True, exist_ok=True)
        (tmp_path / "r" / "_log" / f"aside-{name[-9:-5]}").write_text('{"version": 1, "ba')
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(rollup.log, "publish", lost)
        with pytest.raises(RuntimeError):
            rollup.apply("b", _inserted(spark, 1))
    assert rollup.totals().count() == 0
    assert rollup.apply("b", _inserted(spark, 1)) and not rollup.apply("b", _inserted(spark, 1))
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "t", 1, 5)]


def test_batches_behind_a_snapshot_are_known(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "r"), snapshot_every=2, compact_after=2)
    for i in range(5):
        assert rollup.apply(f"b{i}", _inserted(spark, i, i + 1))
    assert not any(rollup.apply(f"b{i}", _inserted(spark, 99)) for i in range(5))
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "t", 6, 30)] and len(rollup.folders()) <= 3
