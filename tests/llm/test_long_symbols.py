"""Long symbols verify repeats: what they take off the windows, and that nothing else changes."""

import collections

import numpy as np
import pyarrow as pa

from tallybridge.llm import exchange, kernels, recompress, substrings
from tests.llm.test_text_operators import brute_repeats


def corpus(n: int = 60) -> list[tuple[int, str]]:
    rng = np.random.default_rng(11)
    make = lambda k: " ".join(f"v{x}" for x in rng.zipf(1.3, k) % 5000)
    passage, whole = make(80), make(300)
    out = [make(200) for _ in range(n)] + [f"{make(30)} {passage} {make(25)}" for _ in range(n)] + [whole] * 20
    words = whole.split()
    for i in range(20):
        out.append(" ".join(words[: 10 * i] + ["edit"] + words[10 * i + 1 :]))
    return [(i * 2, t) for i, t in enumerate(out)]


def test_result_is_that_of_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_repeats(rows, 13)
    for rounds in (3, 0):
        for r in substrings.remove_repeats(df, rounds=rounds).collect():
            assert (r["n_words"], r["n_removed"], r["kept"]) == want[r["doc_id"]]


def sent_windows(rows, rounds: int) -> tuple[int, int]:
    """Windows that go to buckets, and windows that verified symbols stand for instead."""
    n = 4
    batch = pa.RecordBatch.from_pydict({"owner": [r[0] for r in rows], "text": [r[1] for r in rows]})
    asked = collections.defaultdict(list)
    for b in substrings._send_names(n, 13, rounds)(iter([batch])):
        for row in b.to_pylist():
            asked[row["bucket"]].append(row)
    schema = pa.schema([("bucket", pa.int32()), ("owners", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary()), ("extra", pa.binary())])
    told = collections.defaultdict(bytes)
    for bucket in asked.values():
        answer = substrings._shared_names(n)(pa.Table.from_pylist(bucket, schema=schema))
        for row in answer.to_pylist():
            owners, counts = np.frombuffer(row["owners"], np.int64), np.frombuffer(row["counts"], np.uint32)
            ends = np.cumsum(counts) * 4
            for o, a, b in zip(owners.tolist(), (ends - counts * 4).tolist(), ends.tolist(), strict=True):
                told[o] += row["answer"][a:b]
    batch = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([told.get(r[0]) for r in rows], pa.binary())], names=["owner", "text", "answer"])
    windows = [0, 0]
    for b in substrings._send_windows(n, 13, rounds)(iter([batch])):
        for row in b.to_pylist():
            windows[row["bucket"] >= n] += len(row["keys"]) // 8
    return tuple(windows)


def test_naming_takes_most_windows_off():
    rows = corpus()
    with_names, told = sent_windows(rows, 3)
    without, none = sent_windows(rows, 0)
    assert none == 0 and told > 100 and with_names < 0.5 * without


def test_equal_passages_hold_equal_long_symbols():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 1 << 62, 200).astype(np.uint64)
    a, b = (np.concatenate([rng.integers(0, 1 << 62, 50 + i).astype(np.uint64), passage, rng.integers(0, 1 << 62, 40).astype(np.uint64)]) for i in range(2))
    found = []
    for w in (a, b):
        s = recompress.parse(kernels.mix(w), np.zeros(len(w), np.int64), 3)
        name, more, _, begin, end, step = recompress.long_symbols(s, 13, len(w))
        assert (end - begin >= 13 * 3**step).all() and all((begin[step == k][1:] >= end[step == k][:-1]).all() for k in range(3))
        found.append(set(zip(name.tolist(), more.tolist(), strict=True)))
    assert len(found[0] & found[1]) >= 4
    assert exchange.PACKED
