"""Byte-level BPE by a priority queue over a doubly linked symbol list (operator 9).

The vocabulary file is a parameter; nothing of it is kept in this repository.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded

#: Split of a byte-level vocabulary into pieces that merges never cross (fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a worker remembers at most in each of two generations.
CACHE_ENTRIES = 160_000


class _Cache(dict):
    """piece -> ids as bytes; two generations bound its size and keep frequent pieces."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64 or "\n" in key:
                return value
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder of a byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        shown = _shown_bytes()
        self._byte_id = [vocab[shown[b]] for b in range(256)]
        self._merge = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self._merge[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        byte_of = {c: b for b, c in enumerate(shown)}
        self._bytes = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items()}
        special = {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        self._bytes |= {i: s.encode() for s, i in special.items()}
        self._special = special
        self._special_split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._find = regex.compile(PIECES).findall
        self._pieces = _Cache(lambda piece: np.array(self.merge(piece.encode()), np.uint32).tobytes())
        self._plain = _Cache(lambda chunk: b"".join([self._pieces[x] for x in self._find(chunk)]))
        self._spaced = _Cache(lambda chunk: b"".join([self._pieces[x] for x in self._find(" " + chunk)]))

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank, leftmost first, merges until none is left.

        The queue holds (rank, position) of pairs; the symbols are linked both ways. An entry
        whose symbols have changed since it was pushed is stale and is skipped.
        """
        symbols = [self._byte_id[b] for b in piece]
        n, known = len(symbols), self._merge.get
        if n < 2:
            return symbols
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if (found := known(symbols[i] << 20 | symbols[i + 1])) is not None:
                queue.append((found >> 20, i, symbols[i], symbols[i + 1], found & 0xFFFFF))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            if symbols[i] != left or (j := after[i]) >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := known(made << 20 | symbols[k])) is not None:
                    heapq.heappush(queue, (found >> 20, i, made, symbols[k], found & 0xFFFFF))
            if (h := before[i]) >= 0 and (found := known(symbols[h] << 20 | made)) is not None:
                heapq.heappush(queue, (found >> 20, h, symbols[h], made, found & 0xFFFFF))
        return [s for s in symbols if s >= 0]

    def _ordinary(self, text: str) -> bytes:
        """A cut before a space that a non-space follows never changes the pieces, so such
        chunks are encoded on their own and remembered."""
        if not text:
            return b""
        if _TOUCHING.search(text):
            return b"".join([self._plain[x] for x in _CUTS.split(text)])
        first, *rest = text.split(" ")
        return (self._plain[first] if first else b"") + b"".join(map(self._spaced.__getitem__, rest))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids (uint32) of a whole text; null and empty give none."""
        if not text:
            return np.zeros(0, np.uint32)
        if self._special_split is None or not any(s in text for s in self._special):
            return np.frombuffer(self._ordinary(text), np.uint32)
        out = [np.array([self._special[x]], np.uint32).tobytes() if x in self._special else self._ordinary(x) for x in self._special_split.split(text)]
        return np.frombuffer(b"".join(out), np.uint32)

    def decode(self, ids: Iterable[int]) -> str:
        """Concatenate the vocabulary strings; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")


_TOUCHING = re.compile(r" (?:\s|$)")
_CUTS = re.compile(r"(?= \S)")


def _shown_bytes() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b if b in keep else next(moved)) for b in range(256)]


@functools.cache
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = True) -> DataFrame:
    """(id, n_tokens, ids array<int>) of every whole text, and the text decoded from its ids; where that
    column is not wanted, the ids are decoded too and held against the text, and one that differs is an error.

    Null and empty texts give no ids and an empty text; a null id stays null; rows that repeat
    are encoded each; other columns are ignored, whatever their names; no row, no result.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for rows in _slices(batch):
                texts = rows.column(1).to_pylist()
                ids = [bpe.encode(t) for t in texts]
                back = [bpe.decode(x.tolist()) for x in ids]
                ends = np.cumsum([0, *map(len, ids)])
                flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
                made = [rows.column(0), pa.array(np.diff(ends), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
                if decoded:
                    made.append(pa.array(back, pa.string()))
                elif any(b != (t or "") for b, t in zip(back, texts, strict=True)):
                    raise ValueError("ids do not decode to their text")
                yield pa.RecordBatch.from_arrays(made, names=[id_col, "n_tokens", "ids", "decoded"][: len(made)])

    return bounded(docs).select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids array<int>" + (", decoded string" if decoded else ""))


def digest_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the same work as ``encode_documents``, whose
    ids and texts are digested where they are made instead of being sent on."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                n.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids.tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return bounded(docs).select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
