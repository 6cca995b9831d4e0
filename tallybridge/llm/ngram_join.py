"""Exact Jaccard join of n-gram sets (operator 4): a universe partition and the pigeonhole.

Two sets of at most U n-grams that reach the wanted similarity differ in at most H of them.  The
universe of n-grams is split by hash into segments; H differences cannot touch every segment, so
some segments of the two sets are equal - or differ by one where one-deletion neighbourhoods are
indexed.  For each size band the cheaper of two allocations is taken (``allocate``):

* subsets: 2H + 1 segments, of which each set indexes H + 1.  Up to H segments are skipped: those
  whose content very many sets share, then the emptiest.  (At least H + 1 segments of such a pair
  are equal and each side skips H of them by the same order, so one indexed segment is equal.)
* neighbourhoods: ceil((H + 1) / 2) larger segments, each indexed whole and with any one n-gram
  left out; one of them differs by at most one.

A set goes into its own band and into the next ones as far as a larger partner may sit there.  Sets
that are equal (128 bits of a fingerprint) form one class before any pair is made, and of a class
that holds more than a ten-thousandth of the rows one row alone sends signatures.  Signatures that
a sample of the classes shows to be frequent are dealt out in salted pieces, each with a head of
its own, and the heads are joined; the sample changes the cost, never the result.

A group of sets with one signature is first joined as a star.  Members that are then in different
components are compared with each other inside tasks, block by block, by a profile of counts that
bounds their difference from below.  The members of pairs that it leaves open are sent again with
their words, and the tasks verify such pairs and pass on only links between what no link has joined
before: fewer than members.  To verify is to compare the words of the shingles themselves.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm import exchange
from tallybridge.llm.common import bounded, buckets, cut, discard, stored
from tallybridge.llm.components import components
from tallybridge.llm.kernels import document_sets, mix, steps, words

NGRAM, PERCENT = 4, 85
#: Size bands grow by this factor.
BAND_GROWTH = 1.25
#: Classes that show which signatures are frequent: one of so many. FREQUENT: classes that share one.
SAMPLE, FREQUENT = 16, 1024
#: Bound of the list of frequent signatures (16 bytes each); which ones it holds changes the cost only.
FREQUENT_MOST = 200_000
#: A class of more than one row in so many (and of 64) sends once: at most so many are broadcast.
LARGE_CLASS = 10_000
#: One n-gram in so many tells how often sets of unlike sizes share one.
RATE_SAMPLE = 128
#: Ids of sets to rebuild that are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 250_000
#: Slots of the profile that rules out pairs before words are sent, members of a group that are
#: compared in one piece (of a larger group every pair of pieces is a unit of work), and rows that
#: the units of one head may bring to one task.
PROFILE, COARSE, UNIT_ROWS, PACK_ROWS = 512, 64, 4096, 8192
#: Bytes of words of one piece, of what the units of one head bring to one task, and pairs that a
#: task remembers as not similar (overlapping groups ask for them again).
UNIT_BYTES, PACK_BYTES, REFUTED_MOST = 16 << 20, 32 << 20, 500_000
#: Bytes that a signature takes on the wire, and a word of a text that is verified.
SIGNATURE_BYTES, WORD_BYTES = 20, 7
_STEP = 1 << 20


def most_different(size: int, percent: int) -> int:
    """Largest symmetric difference of two sets of at most this size that are similar enough."""
    return 2 * size * (100 - percent) // (100 + percent)


@functools.cache
def bands(percent: int) -> np.ndarray:
    """Upper sizes of the bands, up to the largest array there can be."""
    uppers = [1]
    while uppers[-1] < 1 << 31:
        uppers.append(max(uppers[-1] + 1, int(uppers[-1] * BAND_GROWTH)))
    return np.array(uppers)


@functools.cache
def allocate(upper: int, percent: int, repeat_rate: float = 0.1) -> tuple[bool, int, int]:
    """(neighbourhoods?, segments, signatures to keep) of the band whose largest size is upper.

    Cost in bytes: signatures sent, and the texts of candidates that arise because each n-gram of
    a segment stands in an unlike set too, at repeat_rate (measured on the data) by chance.
    """
    h = most_different(upper, percent)
    if h == 0:
        return False, 0, 0  # only equal sets are similar enough
    few, many = -(-(h + 1) // 2), 2 * h + 1
    candidate = 2 * upper * WORD_BYTES + 2 * SIGNATURE_BYTES
    subsets = (h + 1) * (SIGNATURE_BYTES + candidate * repeat_rate ** (1.3 * upper / many))
    neighbours = (upper + few) * SIGNATURE_BYTES + few * candidate * repeat_rate ** (upper / few - 1)
    return (True, few, few) if neighbours < subsets else (False, many, h + 1)


def _segment_hashes(grams: np.ndarray, at: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, at, mix(grams ^ np.uint64(0x5851F42D4C957F2D)))
    return sums, np.bincount(at, minlength=total)


def signatures(sets: list[np.ndarray], percent: int, frequent: np.ndarray, repeat_rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of its set) of several sets; frequent: sorted signatures to skip first."""
    uppers = bands(percent)
    size = np.array([len(x) for x in sets], np.int64)
    own = np.searchsorted(uppers, size)
    largest_partner = size * 100 // percent
    signs, owners = [], []
    for shift in range(len(uppers)):
        band = own + shift
        use = np.flatnonzero((size > 0) & (band < len(uppers)) & ((shift == 0) | (largest_partner > uppers[np.minimum(band - 1, len(uppers) - 1)])))
        if not len(use):
            break
        plan = [allocate(int(uppers[band[i]]), percent, repeat_rate) for i in use.tolist()]
        near = np.array([p[0] for p in plan], bool)
        for i, p in zip(use[near].tolist(), [p for p in plan if p[0]], strict=True):
            signs.append(_neighbourhoods(sets[i], int(band[i]), p[1]))
            owners.append(np.full(len(signs[-1]), i))
        plain = [(i, p) for i, p in zip(use.tolist(), plan, strict=True) if p[1] and not p[0]]
        if not plain:
            continue
        which = np.array([i for i, _ in plain])
        segments, keep = (np.array([p[k] for _, p in plain], np.int64) for k in (1, 2))
        first = np.cumsum(segments) - segments
        grams = np.concatenate([sets[i] for i in which.tolist()])
        of = np.repeat(np.arange(len(which)), size[which])
        segment = (mix(grams + band[which][of].astype(np.uint64)) % segments[of].astype(np.uint64)).astype(np.int64)
        sums, filled = _segment_hashes(grams, first[of] + segment, int(segments.sum()))
        of = np.repeat(np.arange(len(which)), segments)
        place = np.arange(len(of)) - first[of]
        sign = mix(sums ^ mix(band[which][of].astype(np.uint64) << np.uint64(40) | place.astype(np.uint64)) + filled.astype(np.uint64))
        common = frequent[np.minimum(np.searchsorted(frequent, sign), len(frequent) - 1)] == sign if len(frequent) else np.zeros(len(sign), bool)
        order = np.lexsort((sign, -filled, common, of))
        rank = np.arange(len(of)) - first[of]
        chosen = order[rank < keep[of]]
        signs.append(sign[chosen])
        owners.append(which[of[chosen]])
    if not signs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(signs), np.concatenate(owners)


def _neighbourhoods(grams: np.ndarray, band: int, segments: int) -> np.ndarray:
    segment = (mix(grams + np.uint64(band)) % np.uint64(segments)).astype(np.int64)
    sums, _ = _segment_hashes(grams, segment, segments)
    whole = np.concatenate([sums, sums[segment] - mix(grams ^ np.uint64(0x5851F42D4C957F2D))])
    place = np.concatenate([np.arange(segments), segment]).astype(np.uint64)
    return np.unique(mix(whole ^ mix(np.uint64(band) << np.uint64(40) | place | np.uint64(1 << 39))))


def _set_id(grams: np.ndarray) -> tuple[int, int]:
    """Fingerprint of a whole set: 128 bits as two signed longs, of which the first names its class."""
    if not len(grams):
        return 0, 0
    sums = np.array([mix(grams).sum(), mix(grams ^ np.uint64(0x1B873593CC9E2D51)).sum()], np.uint64)
    one, two = mix(sums + np.uint64(len(grams))).view(np.int64).tolist()
    return one, two


def _class_of(grams: np.ndarray, apart: dict) -> int:
    """The class of a set; apart: classes of different sets whose first 64 bits are equal."""
    one, two = _set_id(grams)
    return apart.get((one, two), one) if apart else one


def _each_step(batch: pa.RecordBatch, ngram: int):
    for a, b, data, offsets in steps(batch, "text", _STEP):
        yield a, b, list(document_sets(words(data, offsets, fold_case=True), ngram))


def _describe(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _each_step(batch, ngram):
                ids = np.array([_set_id(x) for x in sets], np.int64).reshape(-1, 2)
                some = [x[mix(x) % np.uint64(RATE_SAMPLE) == 0].view(np.int64) for x in sets]
                ends = np.cumsum([0, *map(len, some)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array([len(x) for x in sets], pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array([_profile(x) for x in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(some)))],
                    names=["id", "n_shingles", "set_id", "more_id", "profile", "some"],
                )

    return run


def _profile(grams: np.ndarray) -> bytes:
    """How many n-grams fall into each of PROFILE slots, at most 255. The differences of two
    profiles add up to no more than the sets' symmetric difference."""
    return np.minimum(np.bincount((mix(grams) % np.uint64(PROFILE)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8).tobytes()


@dataclass
class _Plan:
    """What all tasks know: small tables of a stated bound."""

    ngram: int
    percent: int
    repeat_rate: float
    apart: dict  # (first, second 64 bits) -> class, of classes that would share a name
    senders: dict  # class of many rows -> the id that sends for it
    hot: np.ndarray  # frequent signatures, sorted
    pieces: np.ndarray  # of each, how many pieces it is dealt out in


def _send(plan, n_buckets: int, sample: int = 1):
    """Signatures of the classes to the buckets; with ``sample``, of one class in so many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            for a, _, sets in _each_step(batch, p.ngram):
                ids = np.array([_class_of(x, p.apart) for x in sets], np.int64)
                own = batch.column(0)[a : a + len(sets)].to_pylist() if p.senders else ids
                use = np.array([len(x) > 0 and (s not in p.senders or p.senders[s] == i) for x, s, i in zip(sets, ids.tolist(), own, strict=True)], bool)
                if sample > 1:
                    use &= mix(ids.view(np.uint64)) % np.uint64(sample) == 0
                some = np.flatnonzero(use)
                if not len(some):
                    continue
                some = some[np.unique(ids[some], return_index=True)[1]]
                sign, at = signatures([sets[i] for i in some.tolist()], p.percent, p.hot, p.repeat_rate)
                order = np.argsort(at, kind="stable")
                sign, at = sign[order], at[order]
                deal = sign
                if len(p.hot):
                    place = np.minimum(np.searchsorted(p.hot, sign), len(p.hot) - 1)
                    n = np.where(p.hot[place] == sign, p.pieces[place], 1).astype(np.uint64)
                    deal = np.where(n > 1, mix(sign + mix(ids[some][at].view(np.uint64)) % n), sign)
                yield exchange.scatter(ids[some], np.bincount(at, minlength=len(some)), sign, n_buckets, None, deal)

    return run


def _runs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a bucket: signatures and classes in order, each once, and the bounds of each signature."""
    keys, owner, _ = exchange.gather(rows)
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    once = np.ones(len(keys), bool)
    once[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[once], owner[once]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0) if len(keys) else np.zeros(0, np.int64)
    return keys, owner, first, np.diff(np.append(first, len(keys)))


def _often(least: int):
    def run(rows: pa.Table) -> pa.Table:
        keys, _, first, n = _runs(rows)
        some = n > least
        return pa.Table.from_arrays([pa.array(keys[first[some]].view(np.int64)), pa.array(n[some])], names=["signature", "n"])

    return run


def _groups(plan):
    """Signatures that several classes share, and pieces of frequent ones, with those classes in
    order, in rows of at most UNIT_ROWS; equal lists of a bucket once."""

    def run(rows: pa.Table) -> pa.Table:
        hot = plan.value.hot
        keys, owner, first, n = _runs(rows)
        parted = hot[np.minimum(np.searchsorted(hot, keys[first]), len(hot) - 1)] == keys[first] if len(hot) else np.zeros(len(first), bool)
        seen: dict[bytes, int] = {}
        for at, k, whole in zip(first.tolist(), n.tolist(), (~parted).tolist(), strict=True):
            if k > 1 and whole:
                seen.setdefault(owner[at : at + k].tobytes(), at)
        cuts = [(a, at, min(UNIT_ROWS, len(x) // 8 - at)) for x, a in seen.items() for at in range(0, len(x) // 8, UNIT_ROWS)]
        cuts += [(a, at, min(UNIT_ROWS, k - at)) for a, k in zip(first[parted].tolist(), n[parted].tolist(), strict=True) for at in range(0, k, UNIT_ROWS)]
        lists = [owner[a + at : a + at + k] for a, at, k in cuts]
        ends = np.cumsum([0, *map(len, lists)])
        flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        which = np.array([a for a, _, _ in cuts], np.int64)
        return pa.Table.from_arrays(
            [pa.array(keys[which].view(np.int64)), pa.array(owner[which]), pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64()))],
            names=["signature", "head", "members"],
        )

    return run


def _folded(plan):
    """Of the chosen rows: the class, and the words in lower case with one space between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            for _, _, data, offsets in steps(batch, "text", _STEP):
                w = words(data, offsets, fold_case=True)
                ids = [_class_of(x, p.apart) for x in document_sets(w, p.ngram)]
                texts = [b" ".join(w.spelled(i, True)) for i in range(len(ids))]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], names=["set_id", "folded"])

    return run


def _shingles(folded: bytes, ngram: int) -> frozenset:
    spelled = folded.split(b" ")
    k = min(ngram, len(spelled))
    return frozenset(b" ".join(spelled[i : i + k]) for i in range(len(spelled) - k + 1))


def _sets_of(texts: list[bytes], ngram: int) -> list[np.ndarray]:
    """Sets of fingerprints of folded texts."""
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    return list(document_sets(words(data, offsets, fold_case=False), ngram))


def _similar(ngram: int, percent: int):
    """Whether two sets are similar enough: first by fingerprints, then by the words of both."""
    known = functools.lru_cache(64)(lambda folded: _shingles(folded, ngram))

    def enough(both: int, x, y) -> bool:
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(x: np.ndarray, y: np.ndarray, of_x: bytes, of_y: bytes) -> bool:
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        at = np.searchsorted(y, x)
        if not enough(int((y[np.minimum(at, len(y) - 1)] == x).sum()), x, y):
            return False
        left, right = known(of_x), known(of_y)
        return enough(len(left & right), left, right)

    return run


def _verify(ngram: int, percent: int):
    """Pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        similar = _similar(ngram, percent)
        for batch in batches:
            for some in (batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                of_x, of_y = (some.column(c).to_pylist() for c in (2, 3))
                keep = [similar(*both) for both in zip(_sets_of(of_x, ngram), _sets_of(of_y, ngram), of_x, of_y, strict=True)]
                yield pa.RecordBatch.from_arrays(some.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _rate(described: DataFrame, percent: int) -> float:
    """How often an n-gram of a set stands in a set of such another size that they cannot be similar."""
    grams = described.select(F.explode("some").alias("gram"), "n_shingles").groupBy("gram").agg(F.count("*").alias("n"), F.min("n_shingles").alias("x"), F.max("n_shingles").alias("y"))
    found = grams.agg(F.sum(F.when(100 * F.col("x") < percent * F.col("y"), F.col("n"))).alias("shared"), F.sum("n").alias("n")).first()
    return round((found["shared"] or 0) / (found["n"] or 1), 3)


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes and links: (id, n_shingles, set_id) of every row, and pairs (a, b) of set ids.

    The pairs are verified and enough to connect what is connected; a set_id stands for all rows
    with that same set.
    """
    spark = docs.sparkSession
    rows = bounded(docs).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(rows.dtypes)["id"]
    first = stored(rows.mapInArrow(_describe(ngram), f"id {kind}, n_shingles long, set_id long, more_id long, profile binary, some array<long>"), "ngram-sets")
    # Two sets of the same first 64 bits: about n * n / 2 ** 65 such rows among n sets.
    apart = {
        (r["set_id"], r["more_id"]): int(mix(np.array([r["set_id"] ^ r["more_id"]], np.int64).view(np.uint64)).view(np.int64)[0])
        for r in first.groupBy("set_id").agg(F.min("more_id").alias("x"), F.max("more_id").alias("y")).where("x <> y").join(first, "set_id").where("more_id <> x").select("set_id", "more_id").distinct().collect()
    }
    described = first
    if apart:
        renamed = spark.createDataFrame([(*k, v) for k, v in apart.items()], "set_id long, more_id long, other long")
        described = first.join(F.broadcast(renamed), ["set_id", "more_id"], "left").withColumn("set_id", F.coalesce("other", "set_id")).drop("other")
    classes = described.where("n_shingles > 0 and id is not null").groupBy("set_id")
    n_rows, n_grams = described.agg(F.count("*"), F.sum("n_shingles")).first()
    large = classes.agg(F.count("*").alias("n"), F.min("id").alias("id")).where(F.col("n") > max(64, n_rows // LARGE_CLASS)).toArrow()
    senders = dict(zip(large.column("set_id").to_pylist(), large.column("id").to_pylist(), strict=True))
    texts = rows.where(F.col("text").isNotNull() & F.col("id").isNotNull())
    plan = _Plan(ngram, percent, _rate(described, percent), apart, senders, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    n = buckets(spark, (n_grams or 0) * SIGNATURE_BYTES // 3)

    def packed(step: _Plan, sample: int, last, kinds: str) -> DataFrame:
        sent = spark.sparkContext.broadcast(step)
        return texts.mapInArrow(_send(sent, n, sample), exchange.PACKED).groupBy("bucket").applyInArrow(last(sent), kinds)

    often = packed(plan, SAMPLE, lambda _: _often(FREQUENT // SAMPLE), "signature long, n long").orderBy(F.col("n").desc(), "signature").limit(FREQUENT_MOST).toArrow()
    hot = often.column(0).to_numpy().view(np.uint64)
    order = np.argsort(hot)
    plan = replace(plan, hot=hot[order], pieces=-(-often.column(1).to_numpy()[order] * SAMPLE // UNIT_ROWS))
    groups = stored(packed(plan, 1, _groups, "signature long, head long, members array<long>"), "ngram-groups")

    star = groups.select(F.explode("members").alias("b"), F.col("head").alias("a")).where("a <> b").select("a", "b")
    tops = groups.groupBy("signature").agg(F.min("head").alias("a"), F.max("head").alias("z")).where("a <> z")
    heads = groups.join(tops, "signature").where("head <> a").select("a", F.col("head").alias("b"))
    known = spark.sparkContext.broadcast(plan)
    checked = _checked(star.union(heads).distinct(), described, texts, known)
    joined = components(checked)
    rest = _across(groups, joined, described, texts, known, n)
    if rest is not None:
        checked = checked.union(rest)
    discard(groups)
    return described.select("id", "n_shingles", "set_id"), checked


def _texts_of(wanted: DataFrame, described: DataFrame, rows: DataFrame, plan) -> tuple[DataFrame, DataFrame]:
    """(set_id, folded) of the wanted set ids, and the table behind it that the caller discards.
    Only texts of those are read again and sent."""
    first = described.where("id is not null").groupBy("set_id").agg(F.min("id").alias("id")).join(wanted, "set_id", "left_semi").select("id")
    first = stored(first, "ngram-wanted")
    few = first.count() <= BROADCAST_IDS
    chosen = rows.join(F.broadcast(first) if few else first.hint("merge"), "id", "left_semi")
    # Rows that repeat an id may have other texts: of each class one is enough, of any other none is asked for.
    sets = stored(chosen.select("id", "text").mapInArrow(_folded(plan), "set_id long, folded binary"), "ngram-texts")
    once = sets.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("folded").alias("folded")) if first.count() < sets.count() else sets
    discard(first)
    return once, sets


def _checked(pairs: DataFrame, described: DataFrame, rows: DataFrame, plan) -> DataFrame:
    """The pairs of set ids that are similar enough."""
    pairs = stored(pairs, "ngram-pairs")
    wanted = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    once, sets = _texts_of(wanted, described, rows, plan)
    with_b = pairs.join(once.select(F.col("set_id").alias("b"), F.col("folded").alias("of_b")), "b")
    with_both = with_b.join(once.select(F.col("set_id").alias("a"), F.col("folded").alias("of_a")), "a").select("a", "b", "of_a", "of_b")
    out = cut(with_both.mapInArrow(_verify(plan.value.ngram, plan.value.percent), "a long, b long"))
    discard(pairs, sets)
    return out


def _across(groups: DataFrame, joined: DataFrame, described: DataFrame, texts: DataFrame, plan, n_packs: int) -> DataFrame | None:
    """Links between members of one group that are in different components; its first member has
    been compared with all.  None if no profiles allow one.

    Members are compared in tasks, in units of at most two blocks: by their profiles, and those of
    some pair that these leave open by their words.  Rows are members, never pairs.
    """
    percent = plan.value.percent
    facts = described.groupBy("set_id").agg(F.first("n_shingles").alias("size"), F.first("profile").alias("profile"))
    # Groups of the same members count once, whatever buckets they come from.
    lists = groups.groupBy("signature").agg(F.min("head").alias("head"), F.sum(F.xxhash64("members").cast("decimal(38,0)")).alias("of"), F.sum(F.size("members")).alias("n"))
    one = lists.where("n > 2").groupBy("head", "of", "n").agg(F.min("signature").alias("signature")).select("signature", "head", "n")
    # Sizes in a group are alike; its head tells how many members fill a block.
    one = one.join(facts.select(F.col("set_id").alias("head"), (F.col("size") * WORD_BYTES).alias("width")), "head")
    one = one.withColumn("piece", F.greatest(F.lit(1), F.least(F.lit(UNIT_ROWS), F.floor(UNIT_BYTES / F.col("width")))))
    # Rows of a head are dealt out once they are many; groups of near copies overlap, and together
    # in a task they compare a pair once.
    split = one.groupBy("head").agg(F.ceil(F.greatest(F.sum("n") / PACK_ROWS, F.sum(F.col("n") * F.col("width")) / PACK_BYTES)).alias("split"))
    one = one.join(split, "head").select("signature", "piece", F.col("head").alias("top"), F.pmod(F.xxhash64("signature"), F.col("split")).alias("turn"))
    open_ = groups.join(one, "signature").select(F.col("signature").alias("g"), "piece", "top", "turn", F.explode("members").alias("node"))
    placed = open_.join(joined, "node", "left").select("g", "piece", "top", "turn", "node", F.coalesce("component", "node").alias("part"))
    several = placed.groupBy("g").agg(F.min("part").alias("x"), F.max("part").alias("y"), F.ceil(F.count("*") / F.first("piece")).alias("blocks")).where("x <> y").select("g", "blocks")
    placed = placed.join(several, "g")
    rows = placed.join(facts, F.col("node") == F.col("set_id"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = rows.withColumn("own", own).select("g", "top", "turn", "node", "part", "size", "profile", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    blocks = [F.least("own", "other"), F.greatest("own", "other")]
    key = F.xxhash64("top", "turn", *blocks)
    units = dealt.select(F.xxhash64("g", *blocks).alias("unit"), key.alias("deal"), F.pmod(key, F.lit(n_packs)).cast("int").alias("pack"), "node", "part", "size", "profile", (F.col("own") <= F.col("other")).alias("low"), (F.col("own") >= F.col("other")).alias("high"))
    left = cut(units.groupBy("pack").applyInArrow(_undecided(percent), "unit long, deal long, node long, part long, size long, low boolean, high boolean"))
    n_bytes = left.agg(F.sum("size")).first()[0]
    if n_bytes is None:
        return None
    n_packs = max(n_packs, -(-n_bytes * WORD_BYTES // PACK_BYTES))
    asked = left.withColumn("pack", F.pmod("deal", F.lit(n_packs)).cast("int"))
    once, sets = _texts_of(left.select(F.col("node").alias("set_id")).distinct(), described, texts, plan)
    sent = asked.select(F.col("pack").alias("to"), F.col("node").alias("set_id")).distinct().join(once, "set_id").select("to", F.col("set_id").alias("node"), "folded")
    out = cut(asked.groupBy("pack").cogroup(sent.groupBy("to")).applyInArrow(_linked(plan.value.ngram, percent), "a long, b long").distinct())
    discard(sets)
    return out


def _coarse(profile: np.ndarray) -> np.ndarray:
    return profile.reshape(len(profile), COARSE, -1).sum(2, dtype=np.int16)  # sums bound no less


def _units(unit: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the rows of each unit."""
    order = np.argsort(unit, kind="stable")
    return iter(np.split(order, np.flatnonzero(np.diff(unit[order])) + 1) if len(order) else [])


def _undecided(percent: int):
    """The members of a unit that are in some pair of different components whose profiles allow the similarity."""

    def run(rows: pa.Table) -> pa.Table:
        unit, part, size = (rows.column(c).to_numpy() for c in ("unit", "part", "size"))
        low, high = (rows.column(c).to_numpy() for c in ("low", "high"))
        profile = np.frombuffer(b"".join(rows.column("profile").to_pylist()), np.uint8).reshape(-1, PROFILE).astype(np.int16)
        coarse = _coarse(profile)
        wanted = np.zeros(len(unit), bool)
        for here in _units(unit):
            left, right = here[low[here]], here[high[here]]
            for at in range(0, len(left), 64):
                some = left[at : at + 64]
                i, j = np.nonzero((part[some][:, None] != part[right][None, :]) & ((100 - percent) * size[right][None, :] + (100 - percent) * size[some][:, None] >= (100 + percent) * np.abs(size[right][None, :] - size[some][:, None])))
                i, j = some[i], right[j]
                for k in range(0, len(i), 1 << 16):
                    x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                    for level in (coarse, profile):
                        new = ~(wanted[x] & wanted[y])
                        x, y = x[new], y[new]
                        least = np.abs(level[x] - level[y]).sum(1, dtype=np.int64)
                        ok = least * (100 + percent) <= (size[x] + size[y]) * (100 - percent)
                        x, y = x[ok], y[ok]
                    wanted[x] = True
                    wanted[y] = True
        return rows.select(["unit", "deal", "node", "part", "size", "low", "high"]).filter(pa.array(wanted))

    return run


def _linked(ngram: int, percent: int):
    """Links between members of a unit by their words, each of which joins two components of the
    pack that no link before it has joined: fewer than there are components."""

    def run(rows: pa.Table, texts: pa.Table) -> pa.Table:
        folded = texts.column("folded").to_pylist()
        sets = [x for at in range(0, len(folded), 64) for x in _sets_of(folded[at : at + 64], ngram)]
        size = np.array([len(x) for x in sets], np.int64)
        profile = np.frombuffer(b"".join(map(_profile, sets)), np.uint8).reshape(-1, PROFILE).astype(np.int16)
        coarse = _coarse(profile)
        ids = texts.column("node").to_numpy()
        order = np.argsort(ids, kind="stable")
        at = order[np.searchsorted(ids, rows.column("node").to_numpy(), sorter=order)]  # of each row, its text
        _, of_row = np.unique(rows.column("part").to_numpy(), return_inverse=True)
        part = np.zeros(len(ids), np.int64)
        part[at] = of_row  # a node has one component
        low, high = (rows.column(c).to_numpy() for c in ("low", "high"))
        similar, refuted, links = _similar(ngram, percent), set(), []
        for here in _units(rows.column("unit").to_numpy()):
            left, right = at[here[low[here]]], at[here[high[here]]]
            for x in left.tolist():
                y = right[part[right] != part[x]]
                y = y[(100 - percent) * (size[y] + size[x]) >= (100 + percent) * np.abs(size[y] - size[x])]
                for level in (coarse, profile):
                    if len(y):
                        y = y[np.abs(level[y] - level[x]).sum(1, dtype=np.int64) * (100 + percent) <= (size[y] + size[x]) * (100 - percent)]
                for z in y.tolist():
                    pair = (min(x, z), max(x, z))
                    if part[x] == part[z] or pair in refuted:
                        continue
                    if similar(sets[x], sets[z], folded[x], folded[z]):
                        links.append((min(ids[x], ids[z]), max(ids[x], ids[z])))
                        part[part == part[z]] = part[x]
                        continue
                    if len(refuted) >= REFUTED_MOST:
                        refuted.clear()
                    refuted.add(pair)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.Table.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    A-Z count as a-z; a text of fewer words than ``ngram`` is one shingle; null, empty and blank
    texts have no shingle and are linked with nothing; equal sets are linked.  component_id is the
    smallest id that links reach; rows with a null id have none (null) and link no others; rows
    that repeat share their id and component; other columns are ignored; an empty table gives an
    empty result.
    """
    described, links = link(docs, id_col, text_col, ngram, percent)
    classes = described.where("n_shingles > 0 and id is not null").groupBy("set_id").agg(F.min("id").alias("first"))
    a = classes.select(F.col("set_id").alias("a"), F.col("first").alias("u"))
    b = classes.select(F.col("set_id").alias("b"), F.col("first").alias("v"))
    joined = components(links.join(a, "a").join(b, "b"), "u", "v")
    placed = classes.join(joined, classes["first"] == joined["node"], "left").select("set_id", F.coalesce("component", "first").alias("component"))
    out = described.join(placed, "set_id", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), own).alias("component_id"))
