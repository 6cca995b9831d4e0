"""Token-id files of directly addressable codes (operator 5).

An id is split into chunks of 8 bits, lowest first.  Level k holds the k-th chunk of every id
that has one, and a bitmap with a 1 where the id goes on in level k + 1.  A rank directory
(ones before every 512th bit) turns a position of one level into the position of the next, so
any single id is read with one byte, one bit and one short popcount a level; no block is decoded.

A shard is one binary value (little endian):

    "TBDAC1\\0\\0" | n_docs u64 | n_ids u64 | n_levels u64 | doc ends u64[n_docs]
    per level: n u64 | chunks u8[n] | bitmap u8[ceil(n/8)] | ranks u32[ceil(n/512)], each padded to 8

Shards are rows of a Parquet table (part, seq, local_start, first and last id, payload): Spark's
committer makes a write whole or absent when executors are lost, on any store.
"""

from __future__ import annotations

import functools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded, fresh_path, parts

MAGIC = b"TBDAC1\0\0"
#: A shard is closed at the first document that brings it to so many ids.
SHARD_IDS = 1 << 17
RANK_BITS = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _padded(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """One shard from the ids of its documents (uint32) and the end of each document in them."""
    out, rest, levels = [], ids.astype("<u4"), 0
    while True:
        levels += 1
        more = rest >= 256
        bits = np.packbits(more, bitorder="little")
        full = np.zeros(-(-len(more) // RANK_BITS) * (RANK_BITS // 8), np.uint8)
        full[: len(bits)] = bits
        ones = _ONES[full].reshape(-1, RANK_BITS // 8).sum(1, dtype=np.int64)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        out += [struct.pack("<Q", len(rest)), _padded((rest & 255).astype(np.uint8).tobytes()), _padded(bits.tobytes()), _padded(ranks.tobytes())]
        rest = rest[more] >> np.uint32(8)
        if not len(rest):
            break
    return MAGIC + struct.pack("<QQQ", len(ends), len(ids), levels) + ends.astype("<u8").tobytes() + b"".join(out)


class Shard:
    """Reader of one shard: ``shard[i]`` is random access, ``decode()`` gives all ids."""

    def __init__(self, payload: bytes | pa.Buffer):
        if bytes(memoryview(payload)[:8]) != MAGIC:
            raise ValueError("not a token-id shard")
        n_docs, self.n_ids, levels = struct.unpack_from("<QQQ", payload, 8)
        self.ends = np.frombuffer(payload, "<u8", n_docs, 32).astype(np.int64)
        self.levels, at = [], 32 + 8 * n_docs

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, n, at)
            at += -(-got.nbytes // 8) * 8
            return got

        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            self.levels.append((take("u1", n), take("u1", -(-n // 8)), take("<u4", -(-n // RANK_BITS))))

    def __len__(self) -> int:
        return self.n_ids

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            ones = int(ranks[block]) + int(_ONES[bits[block * RANK_BITS // 8 : i >> 3]].sum())
            i = ones + int(_ONES[bits[i >> 3] & (1 << (i & 7)) - 1])
        return value

    def decode(self) -> np.ndarray:
        value: np.ndarray = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if len(value):
                here[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= value << np.uint32(8)
            value = here
        return value

    def documents(self) -> Iterator[np.ndarray]:
        yield from np.split(self.decode(), self.ends[:-1]) if len(self.ends) else ()


#: Ends of a piece that are always pieces of their own after a letter or digit.
_TAIL = ".,!?;:"
#: Words that a worker remembers at most in each of two generations.
_CACHE_ENTRIES = 500_000


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which sees each distinct word once.

    The vocabularies this serves drop white space and never merge across it, so what stands
    between blanks is encoded on its own and remembered.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        # A word of letters only is one piece, whose last token alone ends a word; so many such
        # words can be encoded in one call and told apart.
        marked = {i: t.endswith("</w>") for t, i in self._library.get_vocab().items()}
        self._closes = np.array([marked.get(i, False) for i in range(max(marked) + 1)]) if any(marked.values()) else None
        self._known: dict[str, bytes] = {"": b""}
        self._old: dict[str, bytes] = {}

    def _learn(self, words: Iterable[str]) -> None:
        if len(self._known) >= _CACHE_ENTRIES:
            self._old, self._known = self._known, {"": b""}
        known, old, split = self._known, self._old, []
        fresh: set[str] = set()

        def ask(w: str) -> None:
            if w not in known:
                if (have := old.get(w)) is None:
                    fresh.add(w)
                else:
                    known[w] = have

        for w in words:
            if (have := old.get(w)) is not None:
                known[w] = have
                continue
            core = w.rstrip(_TAIL)
            if len(core) < len(w) and core[-1:].lower().isalnum():
                tail = w[len(core) :]
                split.append((w, core, tail))
                ask(core)
                ask(tail)
            else:
                fresh.add(w)
        letters = [w for w in fresh if w.lower().isalpha()] if self._closes is not None else []
        alone = list(fresh.difference(letters))
        for at in range(0, len(letters), 256):
            some = letters[at : at + 256]
            ids = np.array(self._library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self._closes[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), (ends * 4).tolist()
                known.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
            else:
                alone += some
        for at in range(0, len(alone), 4096):
            some = alone[at : at + 4096]
            for w, e in zip(some, self._library.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, np.uint32).tobytes()
        for w, core, tail in split:
            known[w] = known[core] + known[tail]

    def encode(self, texts: list[str | None], end: bytes = b"") -> list[bytes]:
        """Ids of each text as uint32 bytes, with ``end`` after each."""
        pieces = [(t or "").replace("\n", " ").split(" ") for t in texts]
        look = self._known.__getitem__
        if missing := set(filterfalse(self._known.__contains__, chain.from_iterable(pieces))):
            self._learn(missing)
            if look.__self__ is not self._known:  # the memory has just begun anew
                self._learn(set(filterfalse(self._known.__contains__, chain.from_iterable(pieces))))
                look = self._known.__getitem__
        return [b"".join(map(look, p)) + end for p in pieces]


@functools.cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_shards(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of all texts to a shard table, in ascending order of id_col.

    Rows are dealt out by ranges of id, sorted and encoded; part p holds smaller ids than part
    p + 1.  Null texts are empty; null ids come first; repeated rows are written each; other
    columns are ignored.  An empty table gives a table without shards.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, closing = encoder(path), np.array([end_id], np.uint32).tobytes()
        keys: list = []
        ids: list[bytes] = []
        part = held = done = seq = 0

        def shard() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // 4 for x in ids])
            blob = pack(np.frombuffer(b"".join(ids), np.uint32), ends)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([done], pa.int64()), pa.array([held], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys, key_type)), pa.array([blob], pa.binary())],
                names=["part", "seq", "local_start", "n_ids", "keys", "payload"],
            )

        for batch in batches:
            key_type = batch.column(1).type
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                part = some.column(0)[0].as_py()
                for key, got in zip(some.column(1).to_pylist(), words.encode(some.column(2).to_pylist(), closing), strict=True):
                    keys.append(key)
                    ids.append(got)
                    held += len(got) // 4
                    if held >= shard_ids:
                        yield shard()
                        keys, ids, seq, done, held = [], [], seq + 1, done + held, 0
        if keys:
            yield shard()

    (
        bounded(docs).select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
        .repartitionByRange(parts(spark), id_col)
        .sortWithinPartitions(id_col, text_col)
        .select(F.spark_partition_id().alias("part"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
        .mapInArrow(run, f"part int, seq int, local_start long, n_ids long, keys array<{kind}>, payload binary")
        .write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(out)
    )


def read_shards(spark: SparkSession, out: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the shard table.

    Only the number of ids of each part (one figure a shuffle partition) meets in the driver.
    """
    shards = spark.read.parquet(out)
    kind = dict(shards.dtypes)["keys"][6:-1]
    starts, total = {}, 0
    for part, n in sorted(map(tuple, shards.groupBy("part").agg(F.sum("n_ids")).collect())):
        starts[part], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(3)[i].as_py())
                keys, n = batch.column(2)[i].values, np.diff(shard.ends, prepend=0)
                start = starts[batch.column(0)[i].as_py()] + batch.column(1)[i].as_py() + shard.ends - n
                crc = [zlib.crc32(x.astype("<u4")) for x in shard.documents()]
                yield pa.RecordBatch.from_arrays([keys, pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    return shards.select("part", "local_start", "keys", "payload").mapInArrow(run, f"`{id_col}` {kind}, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, out: str, wanted: DataFrame, position_col: str = "position") -> DataFrame:
    """(position, token) of single ids, by their number (from 0) over all documents of a shard table.

    Numbers are sent to the shard that holds them and read there by rank, a few bytes each; no
    shard is decoded.  Numbers outside the table, and nulls, give no row; repeats count once.
    """
    shards = spark.read.parquet(out)
    starts, total = [], 0
    for part, n in sorted(map(tuple, shards.groupBy("part").agg(F.sum("n_ids")).collect())):
        starts, total = [*starts, (part, total)], total + n
    if not starts:
        return spark.createDataFrame([], "position long, token long")
    first = spark.createDataFrame(starts, "part int, part_start long")
    placed = shards.join(F.broadcast(first), "part").withColumn("start", F.col("part_start") + F.col("local_start"))
    # A number meets the shards of its stretch of SHARD_IDS numbers; a shard lies in a few stretches.
    stretch = lambda c: F.floor(c / SHARD_IDS).cast("long")
    spans = placed.where("n_ids > 0").select("part", "seq", "start", "n_ids", F.explode(F.sequence(stretch(F.col("start")), stretch(F.col("start") + F.col("n_ids") - 1))).alias("stretch"))
    asked = wanted.select(F.col(f"`{position_col}`").cast("long").alias("position")).where("position >= 0").distinct().withColumn("stretch", stretch(F.col("position")))
    held = asked.join(spans, "stretch").where("position >= start and position < start + n_ids")
    by_shard = held.groupBy("part", "seq", "start").agg(F.sort_array(F.collect_list("position")).alias("positions"))  # at most a shard's ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, positions, payload in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                shard, positions = Shard(payload.as_buffer()), positions.as_py()
                yield pa.RecordBatch.from_arrays([pa.array(positions, pa.int64()), pa.array([shard[p - start] for p in positions], pa.int64())], names=["position", "token"])

    return by_shard.join(shards.select("part", "seq", "payload"), ["part", "seq"]).select("start", "positions", "payload").mapInArrow(run, "position long, token long")


def tokenise(docs: DataFrame, path: str, end_id: int, out: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shard table (in the shared folder unless ``out`` is given) and read it back."""
    out = out or fresh_path(docs.sparkSession, "token-ids")
    write_shards(docs, out, path, end_id, id_col, text_col)
    return read_shards(docs.sparkSession, out, id_col)


def count_documents(docs: DataFrame, path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and n_tokens of every whole text (null and empty texts: 0)."""
    chosen = bounded(docs).select(*keep, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            n = []
            for at in range(0, batch.num_rows, 64):
                n += [len(x) // 4 for x in words.encode(batch.column(len(keep)).slice(at, 64).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    fields = ", ".join(f"`{c}` {t}" for c, t in chosen.select(*keep).dtypes)
    return chosen.mapInArrow(run, f"{fields}, n_tokens long")
