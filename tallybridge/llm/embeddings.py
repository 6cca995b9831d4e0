"""Near-duplicate embeddings by cross-polytope hashing (operator 7).

A vector is normalised, padded to a power of two and turned by three rounds of random signs and a
fast Hadamard transform; its hash is the signed axis nearest to it.  A table joins two such hashes.
Every vector is stored in the bucket of its hash and probes that bucket and the next likely ones.
Vectors that meet in a bucket are compared by cosine in double precision.

A pair is counted once: in the first table where one of the two probes the other's bucket.  What
leaves a bucket are counts and a spanning set of links, never all pairs.  A bucket with more than
UNIT_ROWS entries is cut into blocks and every pair of blocks is a unit of work of its own, so no
task holds a whole bucket and no pair of it is lost.

The number of hashes of a table follows the logarithm of the number of vectors, so that a bucket
holds a few of them at any size; tables and probes follow the hashes, so that recall stays (see
``setting``).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded, buckets, cut, discard, stored
from tallybridge.llm.components import components
from tallybridge.llm.kernels import mix

MIN_COSINE = 0.95
#: Vectors that a bucket is to hold in the mean, and entries of one that are compared in one piece.
BUCKET_ROWS, UNIT_ROWS = 16, 2000
#: At most so many buckets (16 bytes each) are told to the tasks as large at once, in the mean; where more have over
#: UNIT_ROWS entries, the buckets are dealt in several passes, a share of them in each.
LARGE_BUCKETS = 100_000
#: A class of more than one row in so many (and of 64) is joined by a broadcast: at most so many.
LARGE_CLASS = 10_000


@dataclass(frozen=True)
class Setting:
    hashes: int
    tables: int
    probes: int


@functools.cache
def setting(n: float, width: int) -> Setting:
    """For so many buckets of vectors of one length. Simulated recall at a cosine of exactly 0.95 in 64 dimensions:
    1.0000 of 3000 pairs for each of 1 to 4 hashes; a table alone finds 0.98, 0.80, 0.73, 0.67."""
    axes = 2 << max(1, (width - 1).bit_length())
    hashes, most = 1, max(1, 54 // (axes.bit_length() - 1))
    while axes**hashes < n and hashes < most:
        hashes += 1
    return Setting(hashes, 2 + 2 * hashes, max(4, 1 << hashes))


@functools.cache
def _signs(dim: int, table: int, which: int) -> np.ndarray:
    rng = np.random.default_rng([dim, table, which])
    return rng.choice(np.array([-1.0, 1.0]), (3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (its length a power of two), orthonormal."""
    n, dim = x.shape
    step = 1
    while step < dim:
        x = x.reshape(n, dim // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, dim)
        step *= 2
    return x / np.sqrt(dim)


def _nearest_axes(x: np.ndarray, table: int, which: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    for signs in _signs(x.shape[1], table, which):
        x = hadamard(x * signs)
    axes = np.argsort(-np.abs(x), axis=1, kind="stable")[:, :most]
    at = np.take_along_axis(x, axes, axis=1)
    return axes * 2 + (at < 0), np.abs(at)


def codes(unit: np.ndarray, tables: int, probes: int, hashes: int) -> np.ndarray:
    """rows x tables x probes bucket numbers of unit vectors; the first probe is the own bucket."""
    n, width = unit.shape
    dim = 1 << max(1, (width - 1).bit_length())
    padded = np.zeros((n, dim))
    padded[:, :width] = unit
    out = np.empty((n, tables, probes), np.int64)
    most = min(dim, max(probes, 2))
    for t in range(tables):
        code, lost = np.zeros((n, 1), np.int64), np.zeros((n, 1))
        for h in range(hashes):
            axes, size = _nearest_axes(padded, t, h, most)
            code = (code[:, :, None] * (2 * dim) + axes[:, None, :]).reshape(n, -1)
            lost = (lost[:, :, None] + (size[:, :1] - size)[:, None, :]).reshape(n, -1)
            best = np.argsort(lost, axis=1, kind="stable")[:, :probes]
            code, lost = np.take_along_axis(code, best, 1), np.take_along_axis(lost, best, 1)
        out[:, t, : code.shape[1]] = code
        out[:, t, code.shape[1] :] = code[:, :1]
    return out


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, weights and vectors of a batch, those of one length together."""
    ids, weights = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    lists = batch.column(2)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for width in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == width)
        yield ids[which], weights[which], flat[(ends[which] - width)[:, None] + np.arange(width)]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow or underflow in the square
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _keys(code: np.ndarray, width: int) -> np.ndarray:
    """One number for each bucket of each table: rows x tables x probes."""
    t = np.arange(code.shape[1], dtype=np.uint64)[None, :, None]
    return mix(code.astype(np.uint64) << np.uint64(8) | t) ^ mix(np.array([width], np.uint64))


def _codes(v: np.ndarray, n: float) -> np.ndarray:
    at = setting(n, v.shape[1])
    return codes(_unit(v), at.tables, at.probes, at.hashes)


def _entries(v: np.ndarray, n: float) -> tuple[np.ndarray, ...]:
    """Buckets of the vectors, each once a vector: its number, the row, is it the own one, the table."""
    code = _codes(v, n)
    key = _keys(code, v.shape[1])
    first = np.ones(key.shape, bool)
    for p in range(1, key.shape[2]):
        first[:, :, p] = (key[:, :, p : p + 1] != key[:, :, :p]).all(2)
    own = np.zeros(key.shape, bool)
    own[:, :, 0] = True
    row = np.broadcast_to(np.arange(len(v))[:, None, None], key.shape)
    table = np.broadcast_to(np.arange(key.shape[1], dtype=np.uint64)[None, :, None], key.shape)
    return key[first], row[first], own[first], table[first]


def _count(n: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, v in _by_width(batch):
                bucket, times = np.unique(_entries(v, n)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(times, pa.int64())], names=["bucket", "n"])

    return run


_UNITS = "pack int, width int, unit binary, ids binary, weights binary, role binary, vectors binary"


def _deal(wanted: float, n_packs: int, hot, passes: int = 1, turn: int = 0):
    """Send every vector to the units of work of its buckets of this pass: role 1 stored, 2 probing, 3 both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, blocks = hot.value
        for batch in batches:
            for ids, weights, v in _by_width(batch):
                mine = _entries(v, wanted)
                key, row, own, table = (x[mine[0].view(np.int64) % passes == turn] for x in mine) if passes > 1 else mine
                if not len(key):
                    continue
                at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                n = np.where(keys[at] == key, blocks[at], 1) if len(keys) else np.ones(len(key), np.int64)
                place = (mix(ids[row].astype(np.uint64)) % n.astype(np.uint64)).astype(np.int64)
                sent = []
                for as_stored in (False, True):
                    use = np.flatnonzero(own) if as_stored else np.arange(len(key))
                    use = np.repeat(use, n[use])
                    other = np.arange(len(use)) - np.searchsorted(use, use)
                    pair = np.stack([other, place[use]] if as_stored else [place[use], other])
                    sent.append((mix(key[use] + pair[0].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pair[1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) & ~np.uint64(255) | table[use], row[use], np.full(len(use), 1 + (not as_stored))))
                unit, row, role = (np.concatenate(x) for x in zip(*sent, strict=True))
                order = np.lexsort((role, row, unit))
                unit, row, role = unit[order], row[order], role[order]
                again = np.zeros(len(unit), bool)
                again[1:] = (unit[1:] == unit[:-1]) & (row[1:] == row[:-1])
                role[np.flatnonzero(again) - 1] = 3
                unit, row, role = unit[~again], row[~again], role[~again]
                pack = (unit >> np.uint64(20)) % np.uint64(n_packs)
                for k in np.unique(pack).tolist():
                    i = np.flatnonzero(pack == k)
                    r = row[i]
                    blobs = [unit[i], ids[r].astype(np.int64), weights[r].astype(np.int64), role[i].astype(np.int8), v[r]]
                    yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([v.shape[1]], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in blobs]], names=[c.split()[0] for c in _UNITS.split(", ")])

    return run


def _counted_here(ci: np.ndarray, cj: np.ndarray, table: int, smaller: np.ndarray) -> np.ndarray:
    """Is this the one place to count the pair? i probes the bucket of this table where j is
    stored; no earlier table may join them, and if j probes i's bucket too, the smaller id counts."""
    i_probes, j_probes = (ci == cj[:, :, :1]).any(2), (cj == ci[:, :, :1]).any(2)
    earlier = (i_probes | j_probes)[:, :table].any(1)
    return ~earlier & (~j_probes[:, table] | smaller)


def _spanning(pairs: np.ndarray) -> np.ndarray:
    """As few of the links as connect what the pairs connect."""
    nodes, at = np.unique(pairs, return_inverse=True)
    at = at.reshape(-1, 2)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[at[:, 0]], label[at[:, 1]])
        new = label.copy()
        np.minimum.at(new, at[:, 0], low)
        np.minimum.at(new, at[:, 1], low)
        new = new[new]
        if (new == label).all():
            other = np.flatnonzero(label != np.arange(len(nodes)))
            return np.stack([nodes[other], nodes[label[other]]], 1)
        label = new


def _compare(dtype: str, min_cosine: float, wanted: float):
    def run(rows: pa.Table) -> pa.Table:
        width = rows.column("width")[0].as_py()
        take = lambda c, kind: np.frombuffer(b"".join(rows.column(c).to_pylist()), kind)
        unit, ids, weights, role = take("unit", np.uint64), take("ids", np.int64), take("weights", np.int64), take("role", np.int8)
        raw = take("vectors", dtype).reshape(len(unit), width)
        order = np.lexsort((ids, unit))
        cut = np.flatnonzero(np.diff(unit[order], prepend=~unit[order][:1]) != 0)
        count = np.zeros(len(unit), np.int64)
        links = []
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(order)).tolist(), strict=True):
            if b - a < 2:
                continue
            here = order[a:b]
            stored_, probing = here[role[here] & 1 > 0], here[role[here] & 2 > 0]
            if not len(stored_) or not len(probing):
                continue
            right, table = _unit(raw[stored_]), int(unit[here[0]] & np.uint64(255))
            met = []
            for at in range(0, len(probing), 256):
                some = probing[at : at + 256]
                q, s = np.nonzero(_unit(raw[some]) @ right.T >= min_cosine)
                q, s = some[q], stored_[s]
                q, s = q[ids[q] != ids[s]], s[ids[q] != ids[s]]
                if not len(q):
                    continue
                met.append(np.stack([q, s], 1))
            if met:
                pairs = np.concatenate(met)
                links.append(ids[_spanning(pairs)])
                some, place = np.unique(pairs, return_inverse=True)
                place, code = place.reshape(-1, 2), _codes(raw[some], wanted)
                for at in range(0, len(pairs), 1 << 16):
                    (q, s), (i, j) = pairs[at : at + (1 << 16)].T, place[at : at + (1 << 16)].T
                    once = _counted_here(code[i], code[j], table, ids[q] < ids[s])
                    np.add.at(count, q[once], weights[s[once]])
                    np.add.at(count, s[once], weights[q[once]])
        who, at = np.unique(ids, return_inverse=True)
        total = np.zeros(len(who), np.int64)
        np.add.at(total, at, count)
        link = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
        some = np.flatnonzero(total)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([link[:, 0], who[some]]), pa.int64()), pa.concat_arrays([pa.array(link[:, 1], pa.int64()), pa.nulls(len(some), pa.int64())]), pa.concat_arrays([pa.nulls(len(link), pa.int64()), pa.array(total[some], pa.int64())])],
            names=["a", "b", "n"],
        )

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    n_links: other rows linked directly (rows with one and the same vector are linked);
    component_id: the smallest id that links reach; kept: is it the row's own id.  A vector that
    is null, empty or zero, or holds a null, NaN or infinity, links with nothing; so do vectors
    of different lengths, and rows with a null id (component_id null, kept false).  Rows that
    repeat count as other vectors of their component; other columns are ignored; an empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    number = "double" if "double" in dict(vectors.dtypes)[vector_col] else "float"
    rows = bounded(vectors).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast(f"array<{number}>").alias("v"))
    fine = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = rows.where(fine)
    classes = stored(good.groupBy("v").agg(F.min("id").cast("long").alias("rep"), F.count("*").alias("weight")).select("rep", "weight", "v"), "vector-classes")
    n_classes, n_rows, width = classes.agg(F.count("*"), F.sum("weight"), F.max(F.size("v"))).first()
    wanted = n_classes / BUCKET_ROWS
    at = setting(wanted, width or 1)
    n = buckets(spark, n_classes * at.tables * at.probes * (32 + (width or 1) * (8 if number == "double" else 4)), 64 << 20)
    sizes = classes.mapInArrow(_count(wanted), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    large = stored(sizes.where(F.col("n") > UNIT_ROWS), "large-buckets")
    passes = max(1, -(-large.count() // LARGE_BUCKETS))
    parts = []
    for turn in range(passes):
        told = large.where(F.pmod("bucket", F.lit(passes)) == turn).toArrow()
        keys = told.column(0).to_numpy().view(np.uint64)
        order = np.argsort(keys)
        hot = spark.sparkContext.broadcast((keys[order], -(-told.column(1).to_numpy()[order] // UNIT_ROWS)))
        compared = classes.mapInArrow(_deal(wanted, n, hot, passes, turn), _UNITS).groupBy("pack", "width").applyInArrow(_compare("<f8" if number == "double" else "<f4", min_cosine, wanted), "a long, b long, n long")
        parts.append(stored(compared, "vector-links"))
    found = reduce(DataFrame.union, parts)
    counts = found.where("n is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    joined = components(found.where("b is not null"))
    placed = cut(
        classes.join(counts, "rep", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(F.col("v").alias("__v"), "weight", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    discard(*parts, large, classes)
    # Vectors that a large share of the rows repeat are few; those rows are not shuffled.
    bound = max(64, (n_rows or 0) // LARGE_CLASS)
    often = placed.where(F.col("weight") > bound).select(F.col("__v").alias("__often"), F.col("n_links").alias("n_often"), F.col("component_id").alias("of_often"))
    good = good.join(F.broadcast(often), F.col("v") == F.col("__often"), "left")
    rare = good.where("n_often is null").select("id", "v").join(placed.where(F.col("weight") <= bound), F.col("v") == F.col("__v"))
    linked = rare.select("id", "n_links", "component_id").union(good.where("n_often is not null").select("id", "n_often", "of_often"))
    alone = rows.where(~F.coalesce(fine, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"))
    every = linked.union(alone)
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
