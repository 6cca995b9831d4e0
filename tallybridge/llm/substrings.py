"""Removal of word sequences that an earlier document holds (operator 8), by recompression.

1. Every text is parsed by rounds that name runs and pairs (``recompress``).  The distinct names
   of each document go to buckets by name; a bucket tells every document which of its names other
   documents hold too.  With them go the long symbols, which stand for a window of words or more;
   a bucket tells every document which of those a smaller document holds: they are verified
   repeats, and none of their windows goes any further.
2. Of the other windows, one that holds a decided symbol of no other document cannot repeat.  What
   is left are the edges of repeats and their first occurrences; they are verified by fingerprints of
   their whole word sequence, again in buckets, which tell each document the windows that start in
   a smaller one.
3. The words that verified symbols and windows cover are removed.

What crosses the network is packed (``exchange``); buckets follow the bytes of the texts.  Names are
fingerprints of what they stand for, which makes them global without a dictionary; the words that
they and the windows are made of have 64 bits, and equal windows agree in 64 bits and in the bucket
that a second fingerprint names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm import exchange, recompress
from tallybridge.llm.common import bounded, buckets
from tallybridge.llm.kernels import mix, steps, windows, words

WINDOW, ROUNDS = 13, 3
_STEP = 1 << 20
_LOW = np.uint64(0x7FFFFFFF)
#: Marks the answer for a name; one without it is a verified symbol: four times its first word, plus its step.
_NAME = np.uint32(1 << 31)
_LONG = np.dtype([("more", "<u8"), ("at", "<u4")])


def _repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: do several owners have its key, does a smaller one?"""
    order = np.lexsort((owner, keys))
    k, o = keys[order], owner[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    least, most = o[first], o[np.append(first[1:], len(o)) - 1] if len(o) else o
    several, smaller = np.zeros(len(k), bool), np.zeros(len(k), bool)
    several[order] = (most > least)[group]
    smaller[order] = o > least[group]
    return several, smaller


def _parsed(data, offsets, rounds):
    w = words(data, offsets, fold_case=False)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
    return w, doc, recompress.parse(w.hashes, doc, rounds)


def _send_names(n_buckets: int, window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, data, offsets in steps(batch, "text", _STEP):
                w, _, s = _parsed(data, offsets, rounds)
                use = recompress.decided(s, window)
                name, doc = s.name[use], s.doc[use]
                order = np.lexsort((name, doc))
                name, doc = name[order], doc[order]
                once = np.ones(len(name), bool)
                once[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
                yield exchange.scatter(ids[a:b], np.bincount(doc[once], minlength=b - a), name[once], n_buckets)
                if rounds:
                    name, more, doc, begin, _, step = recompress.long_symbols(s, window, len(w.hashes))
                    sent = np.empty(len(name), _LONG)
                    sent["more"], sent["at"] = more, 4 * (begin - w.first[:-1][doc]) + step
                    yield _later(exchange.scatter(ids[a:b], np.bincount(doc, minlength=b - a), name, n_buckets, sent), n_buckets)

    return run


def _later(rows: pa.RecordBatch, n_buckets: int) -> pa.RecordBatch:
    """The same rows in buckets of their own, after the others."""
    return rows.set_column(0, "bucket", pa.array(rows.column(0).to_numpy() + n_buckets, pa.int32()))


def _shared_names(n_buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() < n_buckets:
            keys, owner, _ = exchange.gather(rows)
            hit = np.flatnonzero(_repeated(keys, owner)[0])
            return exchange.answer(owner[hit], (keys[hit] & _LOW).astype(np.uint32) | _NAME, n_buckets)
        keys, owner, sent = exchange.gather(rows, _LONG)
        order = np.lexsort((owner, sent["more"], keys))
        k, m, o = keys[order], sent["more"][order], owner[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1])
        hit = order[o > o[np.flatnonzero(new)][np.cumsum(new) - 1]] if len(k) else order
        return exchange.answer(owner[hit], sent["at"][hit], n_buckets)

    return run


def _send_windows(n_buckets: int, window: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            ids, told = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for a, b, data, offsets in steps(batch, "text", _STEP):
                w, doc, s = _parsed(data, offsets, rounds)
                n = len(w.hashes)
                use = recompress.decided(s, window)
                answers = [np.frombuffer(x.as_py(), np.uint32) if x.is_valid else np.zeros(0, np.uint32) for x in told[a:b]]
                of = np.repeat(np.arange(b - a), [len(x) for x in answers])
                answers = np.concatenate(answers) if len(of) else np.zeros(0, np.uint32)
                named = answers >= _NAME
                known = np.sort(of[named].astype(np.uint64) << np.uint64(32) | (answers[named] ^ _NAME).astype(np.uint64))
                asked = s.doc[use].astype(np.uint64) << np.uint64(32) | (s.name[use] & _LOW)
                at = np.searchsorted(known, asked)
                there = known[np.minimum(at, max(len(known) - 1, 0))] == asked if len(known) else np.zeros(len(asked), bool)
                fits = np.arange(n) + window <= w.first[1:][doc] if n else np.zeros(0, bool)
                verified = np.zeros(n, bool)
                if rounds and n and not named.all():
                    _, _, of_long, begin, end, step = recompress.long_symbols(s, window, n)
                    held = np.isin(4 * begin + step, answers[~named].astype(np.int64) + 4 * w.first[:-1][of[~named]])
                    of_long, begin, end = of_long[held], begin[held], end[held]
                    change = np.bincount(begin, minlength=n + 1) - np.bincount(end - window + 1, minlength=n + 1)
                    verified = np.cumsum(change)[:n] > 0
                    # Every window-th start, and the last one, tell what a verified symbol covers.
                    some = [np.append(np.arange(x, y - window, window), y - window) for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
                    if some:
                        who = np.repeat(of_long, [len(x) for x in some])
                        at = (np.concatenate(some) - w.first[:-1][who]).astype(np.uint32)
                        yield _later(exchange.scatter(ids[a:b], np.bincount(who, minlength=b - a), mix(at.astype(np.uint64)), n_buckets, at), n_buckets)
                start = np.flatnonzero(fits & ~verified & ~recompress.windows_with(s, use[~there], window, n)) if n else np.zeros(0, np.int64)
                if len(start):
                    at = (start - w.first[:-1][doc[start]]).astype(np.uint32)
                    deal = windows(w.hashes, window, 1)[start]
                    yield exchange.scatter(ids[a:b], np.bincount(doc[start], minlength=b - a), windows(w.hashes, window)[start], n_buckets, at, deal)

    return run


def _repeated_windows(n_buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        keys, owner, at = exchange.gather(rows, "<u4")
        told = rows.column("bucket")[0].as_py() >= n_buckets
        hit = np.arange(len(keys)) if told else np.flatnonzero(_repeated(keys, owner)[1])
        return exchange.answer(owner[hit], at[hit], n_buckets)

    return run


def _covered(window: int):
    """Window starts of one document -> first and end word of each stretch they cover."""

    def fold(starts: bytes) -> bytes:
        at = np.unique(np.frombuffer(starts, "<u4")).astype(np.int64)
        new = np.append(True, at[1:] > at[:-1] + window)
        last = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
        return np.stack([at[new], at[last] + window], 1).astype("<u4").tobytes()

    return fold


def _told(packed: DataFrame, stage, fold=bytes) -> DataFrame:
    """Ask the buckets; (owner, answer) with one row for each owner that has an answer."""
    asked = packed.groupBy("bucket").applyInArrow(stage, exchange.ANSWER)
    return asked.groupBy("bucket").applyInArrow(exchange.unpack(4, fold), "owner long, answer binary")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(owner, text). Both joins below read it in this one form, so Spark shuffles the texts once."""
    return bounded(docs).select(F.col(f"`{id_col}`").cast("long").alias("owner"), F.col(f"`{text_col}`").alias("text"))


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(owner, answer): for each document with repeated windows, the stretches of words they cover, as
    pairs of uint32 (first word, end)."""
    texts = _texts(docs, id_col, text_col)
    # Names and windows take about as many bytes as the texts at most; buckets follow them.
    n = buckets(docs.sparkSession, texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    known = texts.where(F.col("owner").isNotNull() & F.col("text").isNotNull())
    names = _told(known.mapInArrow(_send_names(n, window, rounds), exchange.PACKED), _shared_names(n))
    asked = texts.join(names, "owner", "left").select("owner", "text", "answer")
    return _told(asked.mapInArrow(_send_windows(n, window, rounds), exchange.PACKED), _repeated_windows(n), _covered(window))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(id, n_words, n_removed, kept): the words no repeated window covers, joined by one space.

    A window is ``window`` consecutive words of one document; it is repeated if its word sequence
    also starts in a document with a smaller id (an integer).  Null and empty texts have no words;
    rows with a null id are kept as they are and count for no other; rows that share an id
    are one row repeated: never smaller than each other, and alike in what is removed; other columns are ignored; an empty table
    gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    starts = find_repeats(docs, id_col, text_col, window, rounds)
    rows = _texts(docs, id_col, text_col).join(starts, "owner", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in steps(batch, "text", _STEP):
                w = words(data, offsets, fold_case=False)
                raw, removed, kept = w.data.tobytes(), [], []
                for i, told in enumerate(batch.column(2)[a:b]):
                    lo, hi = int(w.first[i]), int(w.first[i + 1])
                    keep = np.ones(hi - lo, bool)
                    if told.is_valid:
                        for first, end in np.frombuffer(told.as_py(), "<u4").reshape(-1, 2).tolist():
                            keep[first:end] = False
                    removed.append(int((~keep).sum()))
                    at = np.flatnonzero(keep) + lo
                    kept.append(b" ".join([raw[s:e] for s, e in zip(w.starts[at].tolist(), w.ends[at].tolist(), strict=True)]).decode())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["owner", "n_words", "n_removed", "kept"])

    done = rows.select("owner", "text", "answer").mapInArrow(run, "owner long, n_words long, n_removed long, kept string")
    return done.select(F.col("owner").cast(kind).alias(id_col), "n_words", "n_removed", "kept")
