"""Spelling variants by a frequency-vector trie (operator 13).

A word becomes the vector of how many letters it has of each letter group; a trie arranges the words
by the successive counts.  Words at one edit differ by a surplus of one letter in one group (an insertion),
by that and a deficit of one in another (a replacement), or not at all (a replacement inside a group).
A depth-first search from the root spends such a budget of one surplus and one deficit; the words of
the leaves it reaches are verified.

Spark shares the trie out by its upper levels: a word is kept at the prefix of its own vector and sent to the
prefixes that the budget reaches, with the budget that is left; the tasks search the lower levels.  A surplus
comes before a deficit in the order of the groups, so of two words one finds the other, in one prefix.
As many levels are shared out as make the largest prefix small (CLASS_WORDS); words of one whole vector that
are more than that are dealt once more, by what is left of a word without one letter, in which two near words agree.

Two leaves are verified without comparing all their words: words that agree without the letter that the path
names (a letter of the surplus group on one side, of the deficit group at the same place on the other) are looked
up by a hash of the rest, and then compared letter by letter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded, buckets, discard, stored
from tallybridge.llm.kernels import _at_place, _byte_codes, mix, steps

MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
#: Letters by how common they are; a group holds those that are GROUPS apart (fixed value).
LETTERS, GROUPS = "etaoinsrhldcumfpgwybvkjxqz", 12
#: Words of one prefix of the trie that a task is to search.
CLASS_WORDS = 50_000
#: Rows of a block of the search, and letters of a block of the verification.
BLOCK, ENTRIES = 1 << 16, 1 << 20
#: Distinct words that a task sums up before it sends them.
HELD_WORDS = 250_000
#: Fixed values of the spelling noise: one run in NOISE loses a letter.
NOISE, POLYNOMIAL = 97, 0xEDB88320


def _letter_groups() -> np.ndarray:
    group = np.arange(256) % GROUPS
    for i, letter in enumerate(LETTERS):
        group[ord(letter)] = i % GROUPS
    return group


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table


GROUP, CRC = _letter_groups(), _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every place of the ranges, and the number of its range."""
    size = stops - starts
    of = np.repeat(np.arange(len(starts)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + starts[of], of


def crc32(seed: np.ndarray, letters: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of byte ranges, each carried on from the crc of what comes before it."""
    order = np.argsort(-length, kind="stable")
    state, at, size = seed[order] ^ np.uint32(0xFFFFFFFF), begin[order], length[order]
    few = 48  # longer ranges are rare
    longer = int(np.searchsorted(-size, -few))
    for place in range(int(min(few, size.max(initial=0)))):
        n = int(np.searchsorted(-size, -place))
        state[longer:n] = CRC[(state[longer:n] ^ letters[at[longer:n] + place]) & np.uint32(255)] ^ (state[longer:n] >> np.uint32(8))
    out = np.empty(len(seed), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:longer].tolist():
        out[i] = zlib.crc32(letters[begin[i] : begin[i] + length[i]].tobytes(), int(seed[i]))
    return out


def spelled(ids: list[str | None], data: np.ndarray, offsets: np.ndarray) -> pa.LargeStringArray:
    """The words of MIN_LETTERS and more of a run of documents, each as often as it occurs."""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    # U+00C0 to U+00FF are the byte C3 and one more.
    wide = data == 0xC3
    inside = _LETTER[data] | wide
    inside[1:] |= wide[:-1]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    begin, end = edge[:-1] == 1, edge[1:] == -1
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    begin[cuts], end[cuts - 1] = True, True
    starts, stops = np.flatnonzero(begin), np.flatnonzero(end) + 1
    points = np.concatenate([[0], np.cumsum(~_CONTINUES[data])])
    long = points[stops] - points[starts] >= MIN_LETTERS
    starts, stops = starts[long], stops[long]
    n_letters, length = (points[stops] - points[starts]), stops - starts
    letters = _LOWER[data[_ranges(starts, stops)[0]]]
    begin = np.cumsum(length) - length
    doc = np.searchsorted(offsets, starts, "right") - 1
    seeds = np.array([0 if i is None else zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    known = np.array([i is not None for i in ids], bool)
    crc = crc32(seeds[doc], letters, begin, length)
    stays = np.ones(len(letters), bool)
    for r in np.flatnonzero((crc % np.uint32(NOISE) == 0) & known[doc]).tolist():
        place = int(crc[r]) % int(n_letters[r])
        a, b = int(begin[r]), int(begin[r] + length[r])
        if n_letters[r] < b - a:
            leads = np.append(np.flatnonzero(~_CONTINUES[letters[a:b]]), b - a)
            stays[a + leads[place] : a + leads[place + 1]] = False
            length[r] -= leads[place + 1] - leads[place]
        else:
            stays[a + place] = False
            length[r] -= 1
        n_letters[r] -= 1
    bounds = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    every = pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters[stays].tobytes()))
    return every.filter(pa.array(n_letters >= MIN_LETTERS))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def sent(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from rows.cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).to_batches(max_chunksize=50_000)

    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, b, data, offsets in steps(batch, 1):
            found = pc.value_counts(spelled(ids[a:b], data, offsets))
            held.append(pa.Table.from_arrays([found.field(0), found.field(1)], schema=kind))
            if sum(t.num_rows for t in held) > 2 * HELD_WORDS:
                held = [summed()]
                if held[0].num_rows > HELD_WORDS:
                    yield from sent(held[0])
                    held = []
    if held:
        yield from sent(summed())


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least MIN_LETTERS letters that occur at least ``min_count`` times."""
    rows = bounded(docs).select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"))
    counted = rows.mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Lexicon:
    """Words as bytes of Latin-1, one a letter: their vectors, and hashes with and without each letter."""

    def __init__(self, letters: np.ndarray, length: np.ndarray):
        self.letters, self.length = letters, length
        self.begin = np.cumsum(length) - length
        self.row = np.repeat(np.arange(len(length)), length)
        self.place = np.arange(len(letters)) - self.begin[self.row]

    @classmethod
    def of(cls, words: pa.Array) -> Lexicon:
        words = words.cast(pa.large_string())
        bounds = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        lead = data == 0xC3
        letters = np.where(_CONTINUES[data], data + np.uint8(0x40), data)[~lead]
        points = np.concatenate([[0], np.cumsum(~lead)])[bounds - bounds[0]]
        return cls(letters, np.diff(points))

    def word(self, i: int) -> bytes:
        return self.letters[self.begin[i] : self.begin[i] + self.length[i]].tobytes()

    def vectors(self) -> np.ndarray:
        flat = np.bincount(self.row * GROUPS + GROUP[self.letters], minlength=len(self.length) * GROUPS)
        return flat.reshape(-1, GROUPS).astype(np.int32)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each word, and of each letter's word without it."""
        if not len(self.letters):
            return np.zeros(len(self.length), np.uint64), np.zeros(0, np.uint64)
        code, keys = _byte_codes(False)[self.letters], _at_place(int(self.length.max()), 13)
        own = code * keys[self.place]
        moved = np.where(self.place > 0, code * keys[self.place - 1], np.uint64(0))
        total = lambda x: np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)])
        before, after = total(own), total(moved)
        a, b, at = self.begin, self.begin + self.length, np.arange(len(self.letters))
        size = self.length.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        whole = mix(before[b] - before[a] + size)
        less = before[at] - before[a][self.row] + after[b][self.row] - after[at + 1]
        return whole, mix(less + (size - np.uint64(0xA24BAED4963EE407))[self.row])


def moves(levels: int) -> list[tuple[int, int]]:
    """Ways to spend the budget on the first levels: (group of the surplus, group of the deficit), -1 for none."""
    return [(-1, -1)] + [(g, -1) for g in range(levels)] + [(g, h) for g in range(levels) for h in range(g + 1, levels)]


_PACKED = "bucket int, letters binary, lengths binary, counts binary, moves binary, pieces binary"
_FIELDS = (("counts", "<i8"), ("moves", "u1"), ("pieces", "<u4"))


def _deal(levels: int, n_buckets: int, large: dict[bytes, int]):
    """Each word to its own prefix and to those that it reaches; ``large``: prefixes that are dealt in so many pieces."""
    ways = np.array(moves(levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = Lexicon.of(batch.column(0))
            n = batch.column(1).to_numpy()
            prefix = words.vectors()[:, :levels]
            whole, less = words.hashes()
            for at in range(len(ways)):
                to = prefix.copy()
                for group, by in zip(ways[at].tolist(), (1, -1), strict=True):
                    if group >= 0:
                        to[:, group] += by
                row = np.flatnonzero((to >= 0).all(axis=1))
                if not len(row):
                    continue
                to = to[row]
                pieces, piece = np.ones(len(row), np.int64), np.zeros(len(row), np.int64)
                if large:
                    pieces = np.array([large.get(x.tobytes(), 1) for x in to.astype(">i4")], np.int64)
                    spread = np.flatnonzero(pieces > 1)
                    # To the pieces of the whole word and of the word without each letter.
                    letter, of = _ranges(words.begin[row[spread]], (words.begin + words.length)[row[spread]])
                    values = np.concatenate([whole[row[spread]], less[letter]])
                    owner = spread[np.concatenate([np.arange(len(spread)), of])]
                    sent = np.unique(np.stack([owner, (values % pieces[owner].astype(np.uint64)).astype(np.int64)]), axis=1)
                    which = np.concatenate([np.flatnonzero(pieces == 1), sent[0]])
                    piece = np.concatenate([np.zeros(int((pieces == 1).sum()), np.int64), sent[1]])
                    row, to, pieces = row[which], to[which], pieces[which]
                key = np.zeros(len(row), np.uint64)
                for level in range(levels):
                    key = mix(key + to[:, level].astype(np.uint64) + np.uint64(1))
                bucket = ((mix(key + piece.astype(np.uint64)) >> np.uint64(20)) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                packed = []
                for group in np.split(order, cut[1:]):
                    r = row[group]
                    letters = words.letters[_ranges(words.begin[r], words.begin[r] + words.length[r])[0]]
                    packed.append((int(bucket[group[0]]), letters.tobytes(), words.length[r].astype("<u4").tobytes(), n[r].astype("<i8").tobytes(), np.full(len(r), at, "u1").tobytes(), np.stack([pieces[group], piece[group]], axis=1).astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in packed], pa.int32())] + [pa.array([p[i] for p in packed], pa.binary()) for i in range(1, 6)], names=["bucket", "letters", "lengths", "counts", "moves", "pieces"])

    return run


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, and the number of each row's."""
    if rows.size and rows.max() < 32 and rows.min() >= 0 and rows.shape[1] <= 12:
        key = np.zeros(len(rows), np.uint64)
        for j in range(rows.shape[1]):
            key = key << np.uint64(5) | rows[:, j].astype(np.uint64)
        _, first, of = np.unique(key, return_index=True, return_inverse=True)
        return rows[first], of
    found, of = np.unique(rows, axis=0, return_inverse=True)
    return found, of.ravel()


class Trie:
    """Distinct vectors arranged by their successive counts."""

    def __init__(self, leaves: np.ndarray):
        """leaves: distinct rows in lexicographic order."""
        self.width = int(leaves.max(initial=0)) + 1
        self.children: list[np.ndarray] = []
        starts, parent = np.zeros(len(leaves), bool), np.zeros(len(leaves), np.int64)
        starts[:1] = True
        for level in range(leaves.shape[1]):
            starts[1:] |= leaves[1:, level] != leaves[:-1, level]
            first = np.flatnonzero(starts)
            self.children.append(parent[first] * self.width + leaves[first, level])
            parent = np.cumsum(starts) - 1

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the nodes have a child of that count, and that child."""
        keys = self.children[level]
        wanted = node * self.width + count
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        some = np.flatnonzero((count >= 0) & (count < self.width) & (keys[at] == wanted))
        return some, at[some]

    def search(self, wanted: np.ndarray, way: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(number of the vector, leaf, group of the surplus, group of the deficit), in blocks: depth first, with
        what ``way`` (see ``moves``) spends on the first levels, and the rest of the budget below them."""
        if not self.children[0].size or not len(wanted):
            return
        ways = np.array(moves(levels))
        stack = [(0, np.arange(len(wanted)), np.zeros(len(wanted), np.int64), ways[way, 0], ways[way, 1])]
        while stack:
            level, q, node, surplus, deficit = stack.pop()
            if len(q) > BLOCK:
                half = len(q) // 2
                stack += [(level, *(x[half:] for x in (q, node, surplus, deficit))), (level, *(x[:half] for x in (q, node, surplus, deficit)))]
                continue
            if level == len(self.children):
                yield q, node, surplus, deficit
                continue
            count = wanted[q, level].astype(np.int64)
            if level < levels:
                some, child = self.child(level, node, count + (surplus == level) - (deficit == level))
                stack.append((level + 1, q[some], child, surplus[some], deficit[some]))
                continue
            parts = []
            for free, by in ((np.arange(len(q)), 0), (np.flatnonzero(surplus < 0), 1), (np.flatnonzero((surplus >= 0) & (deficit < 0)), -1)):
                some, child = self.child(level, node[free], count[free] + by)
                some = free[some]
                here = np.full(len(some), level)
                parts.append((q[some], child, here if by > 0 else surplus[some], here if by < 0 else deficit[some]))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))


def near_pairs(words: Lexicon, way: np.ndarray, pieces: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows at one edit: one of a word kept here (way 0), and a word that is kept here or sent here."""
    vectors = words.vectors()
    whole, less = words.hashes()
    kept = np.flatnonzero(way == 0)
    leaves, leaf = _distinct(vectors[kept])
    wanted, asked = np.zeros((0, GROUPS), np.int32), np.zeros(len(way), np.int64)
    asked_way = np.zeros(0, np.int64)
    for w in np.unique(way).tolist():
        rows = np.flatnonzero(way == w)
        found, of = _distinct(vectors[rows])
        asked[rows] = of + len(wanted)
        wanted, asked_way = np.concatenate([wanted, found]), np.concatenate([asked_way, np.full(len(found), w)])
    mine = lambda value, row: value % pieces[row, 0].astype(np.uint64) == pieces[row, 1]
    group = GROUP[words.letters]
    entry = np.flatnonzero(mine(less, words.row))

    def by(key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.argsort(key, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(key, minlength=n))])

    order, ask_at = by(asked[words.row[entry]] * GROUPS + group[entry], len(wanted) * GROUPS)
    ask_entry = entry[order]
    own = entry[way[words.row[entry]] == 0]
    leaf_of = np.zeros(len(way), np.int64)
    leaf_of[kept] = leaf
    order, leaf_at = by(leaf_of[words.row[own]] * GROUPS + group[own], len(leaves) * GROUPS)
    leaf_entry = own[order]
    rows = np.flatnonzero(mine(whole, np.arange(len(way))))
    order, row_at = by(asked[rows], len(wanted))
    ask_row = rows[order]

    def verified(left: np.ndarray, right: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """left: letters, or for an insertion rows; right: letters of kept words."""
        pairs = []
        for x, y in zip(left.tolist(), right.tolist(), strict=True):
            b = int(words.row[y])
            a = x if kind == 1 else int(words.row[x])
            one, two, p = spelt(a), spelt(b), int(words.place[y])
            rest = two[:p] + two[p + 1 :]
            if (one == rest) if kind == 1 else one != two and one[:p] + one[p + 1 :] == rest and (kind == 2 or one < two):
                pairs.append((a, b))
        found = np.array(sorted(set(pairs)), np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    spelling: dict[int, bytes] = {}

    def spelt(i: int) -> bytes:
        if (w := spelling.get(i)) is None:
            w = spelling[i] = words.word(i)
        return w

    for q, at, surplus, deficit in Trie(leaves).search(wanted, asked_way, levels):
        for kind, which in enumerate((surplus < 0, (surplus >= 0) & (deficit < 0), deficit >= 0)):
            c, to, g, h = q[which], at[which], surplus[which], deficit[which]
            if kind == 0:
                # Those that are sent here with nothing spent are the words kept here.
                left, right = (ask_at[c * GROUPS], ask_at[(c + 1) * GROUPS]), (leaf_at[to * GROUPS], leaf_at[(to + 1) * GROUPS])
            else:
                left = (row_at[c], row_at[c + 1]) if kind == 1 else (ask_at[c * GROUPS + h], ask_at[c * GROUPS + h + 1])
                right = (leaf_at[to * GROUPS + g], leaf_at[to * GROUPS + g + 1])
            some = (left[1] > left[0]) & (right[1] > right[0])
            left, right = [x[some] for x in left], [x[some] for x in right]
            load = np.cumsum(left[1] - left[0] + right[1] - right[0]) // ENTRIES
            for part in np.split(np.arange(len(load)), np.flatnonzero(np.diff(load)) + 1):
                if not len(part):
                    continue
                i, of_i = _ranges(left[0][part], left[1][part])
                j, of_j = _ranges(right[0][part], right[1][part])
                i, j = (ask_row if kind == 1 else ask_entry)[i], leaf_entry[j]
                tag = lambda of, place: mix(of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + place.astype(np.uint64))
                key_i = (whole[i] ^ tag(of_i, np.zeros(len(i)))) if kind == 1 else less[i] ^ tag(of_i, words.place[i])
                key_j = less[j] ^ tag(of_j, np.zeros(len(j)) if kind == 1 else words.place[j])
                order = np.argsort(key_j)
                low, high = (np.searchsorted(key_j[order], key_i, side) for side in ("left", "right"))
                hit, of = _ranges(low, high)
                if len(hit):
                    yield verified(i[of], j[order[hit]], kind)


_NEAR = "word string, n_near long, form_n long, form string"


def _search(levels: int):
    def run(rows: pa.Table) -> pa.Table:
        joined = lambda name, kind: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind)
        words = Lexicon(joined("letters", np.uint8), joined("lengths", "<u4").astype(np.int64))
        n, way, pieces = (joined(name, kind) for name, kind in _FIELDS)
        pairs = list(near_pairs(words, way.astype(np.int64), pieces.reshape(-1, 2), levels))
        a, b = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int64) for i in (0, 1))
        one, other = np.concatenate([a, b]), np.concatenate([b, a])
        spelt = {i: words.word(i) for i in np.unique(one).tolist()}
        # Of the near words the most frequent, then the first in code-point order, which is that of Latin-1 bytes.
        ranked = np.array(sorted(spelt, key=lambda i: (-int(n[i]), spelt[i])), np.int64)
        rank = np.zeros(len(n), np.int64)
        rank[ranked] = np.arange(len(ranked))
        order = np.lexsort((rank[other], one))
        who, first, count = np.unique(one[order], return_index=True, return_counts=True)
        best = other[order][first]
        text = lambda ids: pa.array([spelt[i].decode("latin-1") for i in ids.tolist()], pa.string())
        return pa.Table.from_arrays([text(who), pa.array(count, pa.int64()), pa.array(n[best], pa.int64()), text(best)], names=["word", "n_near", "form_n", "form"])

    return run


def _class_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, of = _distinct(Lexicon.of(batch.column(0)).vectors())
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in found.astype(">i4")], pa.binary()), pa.array(np.bincount(of, minlength=len(found)), pa.int64())], names=["vector", "n"])


def near_words(words: DataFrame, class_words: int = CLASS_WORDS) -> DataFrame:
    """(word, n_near, form_n, form) of the words (word, n) that have a near one: how many, and of those the one of largest
    n (ties: the smallest in code-point order) with its n."""
    spark = words.sparkSession
    vectors = stored(words.select("word").mapInArrow(_class_sizes, "vector binary, n long").groupBy("vector").agg(F.sum("n").alias("n")), "spelling-vectors")
    for levels in range(1, GROUPS + 1):
        sizes = vectors.groupBy(F.substring("vector", 1, 4 * levels).alias("prefix")).agg(F.sum("n").alias("n"))
        most, n_words = sizes.agg(F.max("n"), F.sum("n")).first()
        if (most or 0) <= class_words:
            break
    # At most one in class_words: prefixes that even the whole vector leaves larger.
    large = {bytes(r[0]): -(-r[1] // class_words) for r in sizes.where(F.col("n") > class_words).collect()} if (most or 0) > class_words else {}
    n_buckets = buckets(spark, (n_words or 0) * len(moves(levels)) * 30, 4 << 20)
    dealt = words.select("word", "n").mapInArrow(_deal(levels, n_buckets, large), _PACKED)
    found = dealt.groupBy("bucket").applyInArrow(_search(levels), _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), F.col("form")))
    near = stored(found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", (-F.col("best.rank")).alias("form_n"), "best.form"), "spelling-near")
    discard(vectors)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): where the forms lead to in the end, by doubled steps.  A form is more than a word, so
    forms make no ring; a way of k forms takes about log2(k) rounds."""
    at = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not at.where("moved").isEmpty():
        step = at.select(F.col("word").alias("__at"), F.col("root").alias("__to"))
        onward = at.join(step, F.col("root") == F.col("__at"), "left")
        after = stored(onward.select("word", F.coalesce("__to", "root").alias("root"), F.col("__to").isNotNull().alias("moved")), "spelling-roots")
        discard(at)
        at = after
    return at.select("word", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_words: int = CLASS_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts.

    Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A to Z lower-cased; where the crc32 of ``<id>:<run>`` is a multiple
    of NOISE, the run loses one letter.  Words of MIN_LETTERS letters that occur MIN_COUNT times count.  form: the near word
    of largest n, if that is at least RATIO times the word's; root: where forms lead.  Null and empty texts have no
    words; a null id takes no letter away; rows that repeat count each; texts and words of any length are read whole;
    other columns are ignored; an empty table gives an empty result.
    """
    words = stored(count_words(docs, id_col, text_col), "spelling-words")
    near = near_words(words, class_words)
    joined = words.join(near, "word", "left").withColumn("has", F.coalesce(F.col("form_n") >= RATIO * F.col("n"), F.lit(False)))
    formed = stored(joined.select("word", F.when(F.col("has"), F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("form_n")).alias("form_n")), "spelling-forms")
    discard(words, near)
    way = roots(formed.where("form is not null"))
    return formed.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
