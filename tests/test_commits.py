"""Commits: two writers, torn writes, replays, promotion of what passed."""

import threading

import pytest
from pyspark.sql import functions as F

from tallybridge.functions.commits import CommitLog, State, fresh_part
from tallybridge.sinks.ledger import SnapshotLedger, StateTable

KIND = "supplier long, content_sha256 string, feed_date string, contract string, metadata string"


def _at_once(*jobs):
    said = [None] * len(jobs)
    gate = threading.Barrier(len(jobs))

    def run(i):
        gate.wait()
        said[i] = jobs[i]()

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return said


def test_of_two_publishers_one_wins(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    said = _at_once(*[lambda i=i: log.publish("_log/x.json", {"i": i}) for i in range(6)])
    assert sorted(said) == [False] * 5 + [True] and log._read("_log/x.json")["i"] == said.index(True)
    assert not [p for p in (tmp_path / "t" / "_log").iterdir() if p.name.startswith("aside")]


def test_names_are_known_behind_snapshots_and_without_the_hint(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"), snapshot_every=3)
    for i in range(8):
        assert log.update(f"b{i}", lambda s: ([(fresh_part(), {"n": len(s.parts)})], []))
    state = log.state()
    assert state.version == 8 and [p.note["n"] for p in state.parts] == list(range(8)) and len(state.recent) == 2
    assert all(log.known(f"b{i}") for i in range(8)) and not log.known("b8")
    assert not log.update("b1", lambda s: pytest.fail("made again"))
    (tmp_path / "t" / "_log" / "last.json").write_text('{"vers')  # a torn hint
    assert log.state().version == 8 and len(log.state().parts) == 8


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path):
    ledger = SnapshotLedger(spark, str(tmp_path / "l"))
    one = spark.createDataFrame([(1, "a", "d1", "v1", "m")], KIND)

    def dies(self, name, content):
        self._write(f"_log/aside-{content['kind']}", '{"version"')
        raise RuntimeError("lost")

    publish, CommitLog.publish = CommitLog.publish, dies
    try:
        with pytest.raises(RuntimeError):
            ledger.append("b", one)
    finally:
        CommitLog.publish = publish
    assert ledger.rows().count() == 0
    assert ledger.append("b", one) and [tuple(r) for r in ledger.rows().collect()] == [(1, "a", "d1", "v1", "m")]


def test_two_writers_of_one_content_give_one_row(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), KIND)
    ledgers = [SnapshotLedger(spark, str(tmp_path / "l")) for _ in range(3)]
    jobs = [lambda i=i: ledgers[i].append(f"b{i}", rows((1, "a", "d1", "v1", "m"), (2, f"own{i}", "d1", "v1", None))) for i in range(3)]
    assert _at_once(*jobs) == [True] * 3
    assert sorted((r["supplier"], r["content_sha256"]) for r in ledgers[0].rows().collect()) == [(1, "a"), (2, "own0"), (2, "own1"), (2, "own2")]


def test_ledger_replays_conflicts_and_repairs(spark, tmp_path):
    ledger = SnapshotLedger(spark, str(tmp_path / "l"))
    rows = lambda *r: spark.createDataFrame(list(r), KIND)
    first = rows((1, "a", "d2", "v1", None), (1, "a", "d1", "v1", None), (1, "b", "d1", "v1", "m"), (None, "c", "d", "v", None), (2, None, "d", "v", None))
    assert ledger.append("one", first) and not ledger.append("one", first)
    got = lambda: {(r["supplier"], r["content_sha256"]): (r["feed_date"], r["contract"], r["metadata"]) for r in ledger.rows().collect()}
    assert got() == {(1, "a"): ("d1", "v1", None), (1, "b"): ("d1", "v1", "m")}
    second = rows((1, "a", "d1", "v1", "found"), (1, "b", "d1", "v2", "m"), (2, "a", "d1", "v1", None))
    assert {tuple(r) for r in ledger.conflicts(second).collect()} == {(1, "b", "contract")}
    assert ledger.append("two", second)
    want = {(1, "a"): ("d1", "v1", "found"), (1, "b"): ("d1", "v1", "m"), (2, "a"): ("d1", "v1", None)}
    assert got() == want and {tuple(r) for r in ledger.conflicts(rows((1, "a", "d1", "v1", "other"))).collect()} == {(1, "a", "metadata")}
    assert ledger.compact() and got() == want and not ledger.compact()
    assert ledger.append("three", rows((3, "z", "d", "v1", None))) and len(got()) == 4 and not ledger.append("one", first)


def test_only_what_passed_is_promoted(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), "supplier long, product_id long, n int")
    state = lambda n: spark.createDataFrame([(s, p, n) for s in (1, 2, 3) for p in range(3)], "supplier long, product_id long, n int")
    batch = lambda *r: spark.createDataFrame(list(r), "supplier long, status string")
    now = lambda: {r["supplier"]: r["n"] for r in table.rows().groupBy("supplier").agg(F.max("n").alias("n")).collect()}
    assert now() == {}
    assert table.promote("r1", state(1), batch((1, "PASS"), (2, "PASS"), (3, "BLOCKED"))) and now() == {1: 1, 2: 1}
    assert table.promote("r2", state(2), batch((1, "FAIL"), (2, "PASS"), (3, "PASS"))) and now() == {1: 1, 2: 2, 3: 2}
    assert not table.promote("r2", state(9), batch((1, "PASS"))) and now() == {1: 1, 2: 2, 3: 2}
    assert table.promote("r3", state(3).where("supplier <> 2"), batch((2, "PASS"))) and now() == {1: 1, 3: 2}
    assert table.rows().count() == 6


def test_a_state_tells_what_came_after(spark):
    state = State(5, (), ((4, "compact", None), (5, "batch", "x")))
    assert state.since(5) == [] and state.since(3) == ["compact", "batch"] and state.since(2) is None
