"""Shuffling many small keys as few rows: packed arrays dealt into buckets by key.

A task packs what a run of documents sends to one bucket into one row: the owners (document
ids), how many keys each sends, the keys and any values that go with them.  Buckets are dealt by
a mixed hash of the key, so a frequent key adds at most one entry for each owner, and a bucket's
size follows the mean.  Tasks sort and compare whole arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallybridge.llm.kernels import mix

PACKED = "bucket int, owners binary, counts binary, keys binary, extra binary"
PACKED_NAMES = ["bucket", "owners", "counts", "keys", "extra"]


def scatter(owners: np.ndarray, counts: np.ndarray, keys: np.ndarray, n_buckets: int, extra: np.ndarray | None = None, deal: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of PACKED. counts: keys of each owner, in order; extra: a fixed-width value a
    key; deal: another hash of what a key stands for, to deal by instead of the key (equal keys
    then also agree in the bucket, as if the key had that many bits more)."""
    bucket = (((keys if deal is None else deal) >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.uint16 if n_buckets < 65536 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    at = np.repeat(np.arange(len(owners)), counts)[order]
    ends = np.cumsum(np.bincount(bucket, minlength=n_buckets))
    sent_keys = keys[order]
    sent_extra = None if extra is None else extra[order]
    rows = []
    for b in np.flatnonzero(np.diff(ends, prepend=0)).tolist():
        part = slice(int(ends[b - 1]) if b else 0, int(ends[b]))
        who, n = np.unique(at[part], return_counts=True)
        rows.append((b, owners[who].tobytes(), n.astype(np.uint32).tobytes(), sent_keys[part].tobytes(), b"" if sent_extra is None else sent_extra[part].tobytes()))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=PACKED_NAMES)


def _concat(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def gather(rows: pa.Table, extra: str | list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Of the rows of one bucket: the key of every entry, its owner, its extra value."""
    owner = np.repeat(_concat(rows.column("owners"), np.int64), _concat(rows.column("counts"), np.uint32))
    return _concat(rows.column("keys"), np.uint64), owner, _concat(rows.column("extra"), extra) if extra else None


ANSWER = "bucket int, owners binary, counts binary, answer binary"


def answer(owner: np.ndarray, values: np.ndarray, n_buckets: int) -> pa.Table:
    """Values for owners, packed for the way back: rows of ANSWER, dealt by a hash of the owner."""
    bucket = (mix(owner.astype(np.uint64)) >> np.uint64(40)) % np.uint64(n_buckets)
    order = np.lexsort((owner, bucket))
    bucket, owner, values = bucket[order], owner[order], values[order]
    cut = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    rows = []
    for a, b in zip(cut.tolist(), np.append(cut[1:], len(bucket)).tolist(), strict=False):
        who, n = np.unique(owner[a:b], return_counts=True)
        rows.append((int(bucket[a]), who.tobytes(), n.astype(np.uint32).tobytes(), values[a:b].tobytes()))
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["bucket", "owners", "counts", "answer"])


def unpack(width: int, fold=bytes):
    """For groupBy("bucket").applyInArrow: one row (owner, answer) for each owner; fold makes the
    answer of an owner's values."""

    def run(rows: pa.Table) -> pa.Table:
        owner = np.repeat(_concat(rows.column("owners"), np.int64), _concat(rows.column("counts"), np.uint32))
        values = np.frombuffer(b"".join(rows.column("answer").to_pylist()), f"V{width}")
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], values[order]
        who, first = np.unique(owner, return_index=True)
        cut = np.append(first, len(owner)).tolist()
        return pa.Table.from_arrays([pa.array(who, pa.int64()), pa.array([fold(values[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], names=["owner", "answer"])

    return run
