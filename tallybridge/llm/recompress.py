"""Recompression of word sequences: rounds that name runs and pairs, the same everywhere.

Round one names runs of one word; every round then splits the symbols by a bit of their name
into left and right ones and names each adjacent (left, right) pair.  A name is a fingerprint of
what it stands for, so tasks need no dictionary to agree on it.  Each symbol carries the range of
words that decided it (its context): equal word sequences hold equal symbols wherever the context
lies inside them.  (Runs are named once: naming them again would widen every context.)

``long_symbols`` goes on pairing until symbols stand for a whole window of words or more.  A long
symbol stands for the same words wherever it occurs, so one that an earlier document holds
verifies all windows inside it at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tallybridge.llm.kernels import mix

#: Contexts that reach the edge of a document: such a symbol is decided inside no window.
_OUT = np.int64(1) << 40


@dataclass
class Symbols:
    name: np.ndarray
    doc: np.ndarray
    left: np.ndarray  # first word of the context
    right: np.ndarray  # word after the context
    begin: np.ndarray  # first word that it stands for
    more: np.ndarray  # a second name, of other mixing


def _runs(s: Symbols) -> Symbols:
    n = len(s.name)
    new = np.ones(n, bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, n))
    last = first + count - 1
    name = np.where(count > 1, mix(s.name[first] + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), s.name[first])
    joined = s.doc[first[1:]] == s.doc[last[:-1]]
    left, right = np.full(len(first), -_OUT), np.full(len(first), _OUT)
    left[1:][joined] = s.left[last[:-1]][joined]
    right[:-1][joined] = s.right[first[1:]][joined]
    more = np.where(count > 1, mix(s.more[first] ^ mix(count.astype(np.uint64) + np.uint64(77))), s.more[first])
    return Symbols(name, s.doc[first], left, right, s.begin[first], more)


def _pairs(s: Symbols, salt: int) -> Symbols:
    n = len(s.name)
    is_left = (mix(s.name ^ np.uint64(0x51ED270B * salt + 1)) & np.uint64(1)).astype(bool)
    next_in = np.zeros(n, bool)
    next_in[:-1] = s.doc[1:] == s.doc[:-1]
    opens = np.zeros(n, bool)
    opens[:-1] = is_left[:-1] & ~is_left[1:] & next_in[:-1]
    closes = np.zeros(n, bool)
    closes[1:] = opens[:-1]
    kept = np.flatnonzero(~closes)
    pair = opens[kept]
    other = np.minimum(kept + 1, n - 1)
    before = np.maximum(kept - 1, 0)
    name = np.where(pair, mix(s.name[kept] * np.uint64(3) + mix(s.name[other])), s.name[kept])
    # A left symbol stays single because of what follows it, a right one because of what precedes.
    right = np.where(pair | next_in[kept], s.right[other], _OUT)
    right = np.where(pair | is_left[kept], right, s.right[kept])
    prev_in = (kept > 0) & (s.doc[before] == s.doc[kept])
    left = np.where(pair | is_left[kept], s.left[kept], np.where(prev_in, s.left[before], -_OUT))
    more = np.where(pair, _paired_more(s.more[kept], s.more[other]), s.more[kept])
    return Symbols(name, s.doc[kept], left, right, s.begin[kept], more)


def _paired_more(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + np.uint64(0x2545F4914F6CDD1D)) * np.uint64(5) + b)


def parse(words: np.ndarray, doc: np.ndarray, rounds: int) -> Symbols:
    """Symbols after the given rounds; words: fingerprints, doc: the document of each word."""
    at = np.arange(len(words), dtype=np.int64)
    s = Symbols(words, doc, at, at + 1, at, mix(words ^ np.uint64(0x6A09E667F3BCC909)))
    if len(words):
        s = _runs(s)
        for k in range(1, rounds + 1):
            s = _pairs(s, k)
    return s


def long_symbols(s: Symbols, window: int, n_words: int, rounds: int = 20) -> tuple[np.ndarray, ...]:
    """(name, second name, document, first word, word after, step) of the symbols that first come
    to stand for ``window`` words or more (step 0), three times as many (1) or nine times (2);
    those take no part in later rounds."""
    steps = np.array([window, 3 * window, 9 * window])
    name, more, doc, begin = s.name, s.more, s.doc, s.begin
    end = np.append(begin[1:], n_words) if len(begin) else begin
    found = []
    for salt in range(100, 100 + rounds):
        n = len(name)
        if n < 2:
            break
        is_left = (mix(name ^ np.uint64(0x51ED270B * salt + 1)) & np.uint64(1)).astype(bool)
        is_open = end - begin < steps[-1]
        pair = np.zeros(n, bool)
        pair[:-1] = is_left[:-1] & ~is_left[1:] & (doc[1:] == doc[:-1]) & is_open[:-1] & is_open[1:]
        first = np.flatnonzero(pair)
        before = np.maximum(end[first] - begin[first], end[first + 1] - begin[first + 1])
        kept = np.ones(n, bool)
        kept[first + 1] = False
        name, more, end = name.copy(), more.copy(), end.copy()
        name[first], more[first], end[first] = mix(name[first] * np.uint64(3) + mix(name[first + 1])), _paired_more(more[first], more[first + 1]), end[first + 1]
        step = np.searchsorted(steps, end[first] - begin[first], "right")
        new = step > np.searchsorted(steps, before, "right")
        found.append((name[first[new]], more[first[new]], doc[first[new]], begin[first[new]], end[first[new]], step[new] - 1))
        name, more, doc, begin, end = name[kept], more[kept], doc[kept], begin[kept], end[kept]
    none = np.zeros(0, np.int64)
    out = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [none.astype(np.uint64), none.astype(np.uint64), none, none, none, none]
    order = np.lexsort((out[5], out[3]))
    return tuple(x[order] for x in out)


def decided(s: Symbols, window: int) -> np.ndarray:
    """Symbols that windows of so many words can hold with their whole context."""
    return np.flatnonzero((s.left >= 0) & (s.right - s.left <= window))


def windows_with(s: Symbols, which: np.ndarray, window: int, n_words: int) -> np.ndarray:
    """For each word: does the window that starts there hold the context of one of these symbols?"""
    change = np.bincount(np.maximum(s.right[which] - window, 0), minlength=n_words + 1).astype(np.int64)
    change -= np.bincount(s.left[which] + 1, minlength=n_words + 1)[: n_words + 1]
    return np.cumsum(change)[:n_words] > 0
