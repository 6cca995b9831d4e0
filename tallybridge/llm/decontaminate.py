"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2).

The test items are partitioned by the number of their shingles.  Each partition has a sketch size
and an index of its own: an item keeps its s smallest shingle hashes (a bottom-s MinHash).  A document that holds the wanted
share of an item's shingles can lack at most m of them, m following from the partition's largest
size; with s = 2 m + 2 it must hold at least s - m of the sketch.  So nothing is missed however
long the document is, and few others become candidates.  Candidates are verified by exact
containment of the shingles themselves (their words), not of their hashes.

The items are the query set: they are sent to the tasks in blocks of bounded size, one pass over
the documents for each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded
from tallybridge.llm.kernels import Words, mix, steps, text_buffers, windows, words

NGRAM, SHARE = 5, 0.8
#: Bound of one block of items: their characters in all (8 MB of text make about 60 MB of index).
BLOCK_CHARS = 8_000_000
_STEP = 1 << 20
_SIEVE = 1 << 20


def partition(size: int) -> int:
    """Largest size of the partition an item of this many shingles belongs to: steps of a fourth."""
    upper = 1
    while upper < size:
        upper = max(upper + 1, upper * 5 // 4)
    return upper


def may_lack(size: int, share: float) -> int:
    """How many of so many shingles a document may lack and still hold the share."""
    return size - int(np.ceil(share * size - 1e-9))


def _spelled(raw: bytes, w: Words, at: int, k: int) -> bytes:
    return b" ".join([raw[w.starts[i] : w.ends[i]] for i in range(at, at + k)])


class Partition:
    """The items of one size range: sketches of one length, and how much of one must be met."""

    def __init__(self, upper: int, share: float):
        self.upper, self.lack = upper, may_lack(upper, share)
        self.length = 2 * self.lack + 2
        self._sketches: list[np.ndarray] = []
        self._items: list[int] = []
        self._needed: list[int] = []

    def add(self, item: int, hashes: np.ndarray, share: float) -> None:
        """The smallest hashes of an item, mixed anew: a bottom-s MinHash."""
        self._sketches.append(hashes[np.argsort(mix(hashes))[: self.length]])
        self._items.append(item)
        self._needed.append(max(1, len(self._sketches[-1]) - may_lack(len(hashes), share)))

    def close(self) -> None:
        owner = np.repeat(np.arange(len(self._items)), [len(x) for x in self._sketches])
        flat = np.concatenate(self._sketches).astype(np.uint64)
        order = np.argsort(flat)
        self.sketch, self.owner = flat[order], owner[order]
        self.items, self.needed = np.array(self._items), np.array(self._needed)

    def candidates(self, doc: np.ndarray, key: np.ndarray) -> np.ndarray:
        """(document, item) pairs that meet enough of a sketch; doc, key: hashes of documents."""
        lo, hi = np.searchsorted(self.sketch, key, "left"), np.searchsorted(self.sketch, key, "right")
        n = hi - lo
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        met = np.unique(np.stack([np.repeat(doc, n), entry], 1), axis=0)  # each sketch entry once a document
        both, hits = np.unique(np.stack([met[:, 0], self.owner[met[:, 1]]], 1), axis=0, return_counts=True)
        both = both[hits >= self.needed[both[:, 1]]]
        return np.stack([both[:, 0], self.items[both[:, 1]]], 1)


class Index:
    """The size partitions of a block of items, and the items' shingles for the exact check."""

    def __init__(self, ids: list, texts: list[str], ngram: int, share: float):
        data, offsets = text_buffers(pa.array([_folded(t) for t in texts], pa.string()))
        w = words(data, offsets, fold_case=False)
        raw = w.data.tobytes()
        self.ngram, self.share = ngram, share
        self.ids, self.sets, self.lengths = [], [], []
        parts: dict[tuple[int, int], Partition] = {}
        for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            if a == b:
                continue
            k = min(ngram, b - a)
            hashes = np.unique(windows(w.hashes[a:b], k))
            upper = partition(len(hashes))
            parts.setdefault((k, upper), Partition(upper, share)).add(len(self.ids), hashes, share)
            self.ids.append(ids[i])
            self.sets.append({_spelled(raw, w, at, k) for at in range(a, b - k + 1)})
            self.lengths.append(k)
        self.partitions: dict[int, list[Partition]] = {}
        self.sieve = np.zeros(_SIEVE, bool)
        for (k, _), part in sorted(parts.items()):
            part.close()
            self.partitions.setdefault(k, []).append(part)
            self.sieve[(part.sketch % np.uint64(_SIEVE)).astype(np.int64)] = True

    def candidates(self, w: Words) -> list[tuple[int, int]]:
        """(document, item) pairs with enough of the sketch in common, partition by partition."""
        last = np.repeat(w.first[1:], np.diff(w.first))
        doc = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
        pairs = [np.zeros((0, 2), np.int64)]
        for k, parts in self.partitions.items():
            every = windows(w.hashes, k)
            at = np.flatnonzero(self.sieve[(every % np.uint64(_SIEVE)).astype(np.int64)])
            at = at[at + k <= last[at]]
            pairs += [part.candidates(doc[at], every[at]) for part in parts]
        return sorted(map(tuple, np.concatenate(pairs).tolist()))

    def find(self, w: Words) -> Iterator[tuple[int, object, int, int]]:
        """(document, item id, shared shingles, shingles of the item), verified."""
        raw, own, at = None, {}, None
        for doc, item in self.candidates(w):
            if doc != at:
                raw, own, at = raw or _folded_bytes(w.data), {}, doc
            k = self.lengths[item]
            if k not in own:
                a, b = int(w.first[doc]), int(w.first[doc + 1])
                own[k] = {_spelled(raw, w, i, k) for i in range(a, b - k + 1)}
            shared = len(self.sets[item] & own[k])
            if shared >= self.share * len(self.sets[item]) - 1e-9:
                yield doc, self.ids[item], shared, len(self.sets[item])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _folded(text: str) -> str:
    return text.encode().translate(_LOWER).decode()


def _folded_bytes(data: np.ndarray) -> bytes:
    return data.tobytes().translate(_LOWER)


def _blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[pa.Table]:
    # A repeated item row counts once, so no block grows by repeats.
    some = items.where(F.col(text_col).isNotNull()).select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).distinct()
    chars = some.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-2 * chars // block_chars)) if chars > block_chars else 1
    for i in range(n):
        yield some.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).toArrow()


def _indexes(docs: DataFrame, items: DataFrame, item_col: str, text_col: str, ngram: int, share: float, block_chars: int):
    for block in _blocks(items, item_col, text_col, block_chars):
        yield docs.sparkSession.sparkContext.broadcast(Index(block.column(0).to_pylist(), block.column(1).to_pylist(), ngram, share))


def _found(index: Index, batch: pa.RecordBatch, text_at: int = 1) -> Iterator[tuple[int, object, int, int]]:
    for a, _, data, offsets in steps(batch, text_at, _STEP):
        for doc, item, shared, size in index.find(words(data, offsets, fold_case=True)):
            yield a + doc, item, shared, size


def find_contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", ngram: int = NGRAM, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, n_shared, n_item): every document that holds at least ``share`` of the distinct
    word shingles of an item.

    A-Z count as a-z.  An item of fewer words than ``ngram`` is one shingle of all its words.
    Null, empty and blank texts, of documents or items, contain and are contained in nothing;
    null ids stay null; rows that repeat are found each (a document once for each distinct
    item row); other columns are ignored; empty tables give an empty result.
    """
    picked = bounded(docs).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    kinds = f"`{id_col}` {dict(docs.dtypes)[id_col]}, `{item_col}` {dict(items.dtypes)[item_col]}, n_shared int, n_item int"
    out = None
    for sent in _indexes(docs, items, item_col, text_col, ngram, share, block_chars):
        one = picked.mapInArrow(_finder(sent, items.schema[item_col].dataType, [id_col, item_col]), kinds)
        out = one if out is None else out.union(one)
    return out


def _finder(sent, item_type, names: list[str]) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_found(sent.value, batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32())],
                names=[*names, "n_shared", "n_item"],
            )

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", ngram: int = NGRAM, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, all columns, that hold no item as ``find_contained`` tells it.

    Rows are dropped where they are read: no row is shuffled.
    """
    columns = bounded(docs).columns
    for sent in _indexes(docs, items, item_col, text_col, ngram, share, block_chars):
        docs = docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(_dropper(sent, columns.index(text_col)), docs.schema)
    return docs


def _dropper(sent, text_at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[row for row, *_ in _found(sent.value, batch, text_at)]] = False
            yield batch.filter(pa.array(keep))

    return run
