"""Hard negatives by slot-decomposed selection (operator 12).

The windows of an anchor's positives overlap: each reaches from half of a positive's score to a little below
it.  The upper limits of the positives, in descending order, split the scores into disjoint slots; every score is in
one slot, and a task keeps of each slot the best few it has seen (a combiner), as Spark does again when the tasks'
rows of a slot meet.  The scores under a positive's upper limit are a suffix of the slots, so merging the slots from
the last to the first, a few rows each, answers all windows; the lower limit then cuts a sorted list.

Two passes: the first finds the positives, the second the slots that they make.  Both compare every
anchor with every row, in blocks: anchors and rows are dealt into groups of bounded size, and each pair of
groups is a unit of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded, discard, parts, stored

#: A component x becomes floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Numbers of a group of rows or anchors that a task holds; rows of a block of them, anchors of a block.
GROUP_NUMBERS, ROWS, ANCHORS = 2 << 20, 8192, 128
_LONG = (1 << 63) - 1
_NONE = np.iinfo(np.int64).min


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond a long, the nearest long."""
    most = max(1.0, np.abs(anchors).max(initial=0)) * max(1.0, np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most < 2.0**45:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.dot(np.array([[int(x) for x in r] for r in anchors.tolist()], object).reshape(anchors.shape), np.array([[int(x) for x in r] for r in rows.tolist()], object).reshape(rows.shape).T)
    return np.array([[max(-_LONG, min(_LONG, x)) for x in r] for r in whole.tolist()], np.int64).reshape(len(anchors), len(rows))


def _best(score: np.ndarray, open_to: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of the matrix the k highest open places, of equal ones the first: (row, column)."""
    k = min(k, score.shape[1])
    if np.abs(score).max(initial=0) < 1 << 45:
        key = np.where(open_to, score * (1 << 17) - np.arange(score.shape[1]), _NONE)
        at = np.argpartition(key, -k, axis=1)[:, -k:]
        chosen = np.take_along_axis(key, at, 1) != _NONE
    else:
        at = np.stack([np.lexsort((np.arange(score.shape[1]), np.where(o, -s, 0), ~o))[:k] for s, o in zip(score, open_to, strict=True)])
        chosen = np.take_along_axis(open_to, at, 1)
    row, which = np.nonzero(chosen)
    return row, at[row, which]


class _Side:
    """Anchors or rows of one length, by id."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        self.id, self.key, self.label = (rows.column(c).to_numpy() for c in ("id", "key", "label"))
        lists = rows.column("v").combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        self.q = np.floor(flat * SCALE).reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 0))
        self.limits = rows.column("limits")

    def take(self, order: np.ndarray) -> None:
        self.id, self.key, self.label, self.q = self.id[order], self.key[order], self.label[order], self.q[order]


def _units(table: pa.Table) -> Iterator[tuple[_Side, _Side]]:
    """Anchors and rows of one length; rows that repeat count once and go by id."""
    for width in set(table.column("width").to_pylist()):
        of = table.filter(pc.equal(table.column("width"), width))
        anchors = _Side(of.filter(of.column("is_anchor")))
        rows = _Side(of.filter(pc.invert(of.column("is_anchor"))))
        order = np.lexsort((rows.key, rows.label, rows.id))
        rows.take(order)
        again = np.zeros(len(order), bool)
        again[1:] = (rows.id[1:] == rows.id[:-1]) & (rows.label[1:] == rows.label[:-1]) & (rows.key[1:] == rows.key[:-1])
        if again.any():
            again[1:] &= (rows.q[1:] == rows.q[:-1]).all(axis=1)
            rows.take(np.flatnonzero(~again))
        if len(anchors.id) and len(rows.id):
            yield anchors, rows


_FOUND = "id long, key long, slot int, score long, other long"


def _compare(k: int, slots: bool):
    """For each anchor of a unit the k best rows of its label, or the k best others of each slot."""

    def run(table: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        for anchors, rows in _units(table):
            limits = _limits(anchors) if slots else None
            for a in range(0, len(anchors.id), ANCHORS):
                some = slice(a, a + ANCHORS)
                held: list[np.ndarray] = []
                for b in range(0, len(rows.id), ROWS):
                    block = slice(b, b + ROWS)
                    score = products(anchors.q[some], rows.q[block])
                    like = anchors.label[some, None] == rows.label[None, block]
                    if limits is None:
                        wanted = [(0, like & (anchors.id[some, None] != rows.id[None, block]))]
                    else:
                        high, low = limits[0][some], limits[1][some]
                        wanted = [(j, ~like & (score <= high[:, j, None]) & (score > high[:, j + 1, None]) & (score >= low[:, j, None])) for j in range(high.shape[1] - 1)]
                    for slot, open_to in wanted:
                        if open_to.any():
                            i, j = _best(score, open_to, k)
                            held.append(np.stack([i, np.full(len(i), slot), score[i, j], rows.id[block][j]]))
                if held:
                    i, slot, score, other = np.concatenate(held, axis=1)
                    order = np.lexsort((other, -score, slot, i))
                    group = i[order] * (1 << 20) + slot[order]
                    first = np.flatnonzero(np.diff(group, prepend=-1))
                    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
                    kept = order[rank < k]
                    out.append((anchors.id[some][i[kept]], anchors.key[some][i[kept]], slot[kept], score[kept], other[kept]))
        columns = [np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(5)]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c.astype(np.int64)).cast(kind) for c, kind in zip(columns, kinds, strict=True)], names=["id", "key", "slot", "score", "other"])

    return run


def _limits(anchors: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Upper limits of each anchor's slots, one more at the end, and the lowest score that a window ending in the slot takes."""
    lists = anchors.limits.to_pylist()
    most = max([len(x) for x in lists], default=0)
    high, low = np.full((len(lists), most + 1), _NONE, np.int64), np.full((len(lists), most + 1), _LONG, np.int64)
    for i, limits in enumerate(lists):
        for j, pair in enumerate(limits):
            high[i, j], low[i, j] = pair["high"], pair["low"]
    return high, low


def _dealt(anchors: DataFrame, rows: DataFrame, of_anchors: int, of_rows: int) -> DataFrame:
    """Each group of anchors with each group of rows."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    limit = "array<struct<high:bigint,low:bigint>>"
    asked = anchors.select("id", "key", "label", "v", "limits", F.lit(True).alias("is_anchor"), deal(of_anchors).alias("of_anchors"), numbers(of_rows).alias("of_rows"))
    held = rows.select("id", "key", "label", "v", F.lit(None).cast(limit).alias("limits"), F.lit(False).alias("is_anchor"), numbers(of_anchors).alias("of_anchors"), deal(of_rows).alias("of_rows"))
    return asked.union(held).withColumn("width", F.size("v")).groupBy("of_anchors", "of_rows")


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The k first rows (score descending, then id) of each group."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _suffixes(positives: Column, entries: Column, k: int) -> Column:
    """array<struct<place, top>>: of each positive the k best entries of its slot and of those below it, merged from the
    last slot to the first."""
    entry = "struct<rank:bigint,other:bigint>"

    def merge(acc: Column, place: Column) -> Column:
        here = F.transform(F.filter(entries, lambda e: e["slot"] == place), lambda e: F.struct((-e["score"]).alias("rank"), e["other"].alias("other")))
        top = F.slice(F.array_sort(F.concat(acc["top"], here)), 1, k)
        return F.struct(top.alias("top"), F.concat(acc["all"], F.array(F.struct(place.alias("place"), top.alias("top")))).alias("all"))

    start = F.struct(F.array().cast(f"array<{entry}>").alias("top"), F.array().cast(f"array<struct<place:int,top:array<{entry}>>>").alias("all"))
    return F.aggregate(F.sequence(F.size(positives) - 1, F.lit(0)), start, merge, lambda acc: acc["all"])


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    group_numbers: int = GROUP_NUMBERS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    The score of a row for an anchor is the inner product of their vectors, each component x taken as floor(SCALE * x);
    higher scores come first, then smaller ids.  An anchor's positives are its first ``positives`` rows of the same
    label and another id; for each, the first ``negatives`` rows of another label whose score is between ``low``
    and ``high`` hundredths of the positive's are returned (a positive of negative score has none).

    Rows with a null id, label or vector, or a null or non-finite component take no part.  Rows of different lengths
    have no score with each other.  Rows that repeat count once; rows that share an id and differ are rows of their own,
    but never each other's positives.  Scores beyond a long count as the nearest long.  Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    number = "double" if "double" in dict(vectors.dtypes)[vector_col] else "float"
    label = F.col(f"`{label_col}`") if isinstance(label_col, str) else label_col
    chosen = bounded(vectors).select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector_col}`").cast(f"array<{number}>").alias("v"), is_anchor.alias("asked"))
    fine = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = stored(chosen.where(fine).withColumn("key", F.xxhash64("v")), "mining-rows")
    every = rows.where("asked").dropDuplicates(["id", "label", "key"]).withColumn("key", F.xxhash64("key", "label"))
    n_rows, n_anchors, width = rows.agg(F.count("*"), F.count_if("asked"), F.max(F.size("v"))).first()
    fits = max(64, group_numbers // max(1, width or 1))
    of_anchors, of_rows = max(1, -(-n_anchors // fits)), max(1, -(-n_rows // fits), min(parts(spark), n_rows // 1024))

    none = F.array().cast("array<struct<high:bigint,low:bigint>>")
    like = _dealt(every.withColumn("limits", none), rows, of_anchors, of_rows).applyInArrow(_compare(positives, False), _FOUND)
    best = _first(like, positives, "id", "key").groupBy("id", "key").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "score"))).alias("positives"))
    # No integer is between the limits of a negative score.
    limit = lambda p: F.struct(F.floor(p["score"] * F.lit(high).cast("decimal(3,0)") / 100).cast("long").alias("high"), F.ceil(p["score"] * F.lit(low).cast("decimal(3,0)") / 100).cast("long").alias("low"))
    known = stored(best.withColumn("positives", F.filter("positives", lambda p: p["score"] >= 0)).where(F.size("positives") > 0).withColumn("limits", F.transform("positives", limit)), "mining-positives")

    slots = stored(_first(_dealt(every.join(known.select("id", "key", "limits"), ["id", "key"]), rows, of_anchors, of_rows).applyInArrow(_compare(negatives, True), _FOUND), negatives, "id", "key", "slot").select("id", "key", "slot", "score", "other"), "mining-slots")
    entries = slots.groupBy("id", "key").agg(F.collect_list(F.struct("slot", "score", "other")).alias("entries"))
    merged = known.join(entries, ["id", "key"]).withColumn("m", F.explode(_suffixes(F.col("positives"), F.col("entries"), negatives)))
    windows = merged.select("id", F.get("positives", F.col("m.place")).alias("p"), F.get("limits", F.col("m.place"))["low"].alias("least"), F.col("m.top").alias("top"))
    found = windows.select("id", "p", F.posexplode(F.filter("top", lambda e: -e["rank"] >= F.col("least"))).alias("pos", "e"))
    result = found.select(F.col("id").alias("anchor_id"), F.col("p.other").alias("positive_id"), (F.col("pos") + 1).cast("int").alias("rank"), F.col("e.other").alias("negative_id"), F.col("p.score").alias("positive_score"), (-F.col("e.rank")).alias("negative_score"))
    out = stored(result, "hard-negatives")
    discard(rows, known, slots)
    return out
