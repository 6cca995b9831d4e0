"""Vectorised word and shingle fingerprints over Arrow string columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 never uses
those bytes inside a character, so bytes and characters give the same words.
Fingerprints are 64 bits: a sum over the bytes of a word, each times a factor of its place, mixed;
then the like over the words of a shingle.  They are the same on every machine.  They choose
candidates; where a result depends on equality, operators compare the words or more bits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes of text that one vectorised step handles at a time (bounds memory; no text is cut).
STEP_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; a bijection on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_codes(fold_case: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


_place_keys: dict[int, np.ndarray] = {}


def _at_place(n: int, salt: int) -> np.ndarray:
    """A random-looking factor for each of the first n places of a word."""
    have = _place_keys.get(salt)
    if have is None or len(have) < n:
        size = 1 << max(8, (n - 1).bit_length())
        have = mix(mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(salt))
        if size <= 1 << 20:
            _place_keys[salt] = have
    return have[:n]


class Words:
    """Words of a run of documents: hashes, byte bounds and the first word of each document."""

    __slots__ = ("data", "hashes", "starts", "ends", "first")

    def __init__(self, data, hashes, starts, ends, first):
        self.data, self.hashes, self.starts, self.ends, self.first = data, hashes, starts, ends, first

    def spelled(self, i: int, fold_case: bool) -> list[bytes]:
        """The words of document i themselves."""
        raw = self.data[self.starts[self.first[i]] : self.ends[self.first[i + 1] - 1]].tobytes() if self.first[i] < self.first[i + 1] else b""
        return (raw.translate(_LOWER) if fold_case else raw).split()


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _word_hashes(letters: np.ndarray, length: np.ndarray, fold_case: bool, salt: int) -> np.ndarray:
    """A factor of its own for every place of a word: no two texts cancel out by their structure,
    as they do in a polynomial modulo 2**64."""
    begin = np.cumsum(length) - length
    place = np.arange(len(letters)) - np.repeat(begin, length)
    terms = _byte_codes(fold_case)[letters] * _at_place(int(length.max()), salt)[place]
    return mix(np.add.reduceat(terms, begin) + length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def words(data: np.ndarray, offsets: np.ndarray, fold_case: bool) -> Words:
    """data: bytes of all documents; offsets: n + 1 bounds inside data."""
    n_docs, data = len(offsets) - 1, data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_SPACE[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(data, np.zeros(0, np.uint64), none, none, np.zeros(n_docs + 1, np.int64))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = np.zeros(len(data) + 1, bool)
    end[1:] = inside
    end[1:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    begin[cuts] = True
    end[cuts] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return Words(data, _word_hashes(data[inside], ends - starts, fold_case, 0), starts, ends, np.searchsorted(starts, offsets))


@functools.cache
def _factors(k: int, salt: int) -> tuple[np.uint64, ...]:
    return tuple(mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F + 2 * salt)) | np.uint64(1))


def windows(hashes: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Fingerprints of every k consecutive hashes; n - k + 1 of them, or none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(_factors(k, salt)):
        out += hashes[j : j + n] * factor
    return mix(out + np.uint64(k))


def document_sets(w: Words, k: int) -> Iterator[np.ndarray]:
    """Per document its sorted distinct k-word shingles; fewer words: the sequence as one."""
    every = windows(w.hashes, k)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            yield windows(w.hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 bounds of a string column without copying it; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def steps(batch: pa.RecordBatch, text: str | int, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch of about step_bytes of text: first row, last row, bytes, bounds."""
    data, offsets = text_buffers(batch.column(text))
    row = 0
    while row < batch.num_rows:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + step_bytes, "right")) - 1)
        yield row, last, data, offsets[row : last + 1]
        row = last
