"""Quality classifier: a byte-level convolutional network in numpy (operator 3).

Bytes are embedded, learned filters run over windows of 8 bytes at every 4th byte, the filters
are max-pooled over overlapping chunks of 512 bytes (one begins every 256 bytes, so the whole
text is covered), a small hidden layer reads each chunk, and the mean and the maximum of what it
finds are combined into one probability.  Learning runs on the driver over a bounded sample of
labelled rows; scoring runs in the tasks over every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybridge.llm.common import bounded
from tallybridge.llm.kernels import steps, text_buffers

WIDTH, STRIDE, BLOCK = 8, 4, 64  # bytes of a window, bytes between windows, windows of half a chunk
DIM, FILTERS, HIDDEN = 8, 48, 16
#: Bound of the learning sample: labelled documents, and bytes of one of them. Scoring has no bound.
SAMPLE_ROWS, SAMPLE_TEXT_BYTES = 2400, 200_000
THRESHOLD = 0.7
#: Steps of learning at least, where rows are few.
LEAST_STEPS = 500
_STEP = 384 << 10
#: Bytes that are looked at at once (a multiple of a block).
_PIECE = 256 << 10


@dataclass
class Network:
    embed: np.ndarray  # 256 x DIM
    filters: np.ndarray  # WIDTH * DIM x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN, applied to each chunk
    hidden_bias: np.ndarray
    last: np.ndarray  # of the mean and of the maximum over chunks
    last_bias: np.ndarray
    names: tuple = field(default=("embed", "filters", "bias", "hidden", "hidden_bias", "last", "last_bias"), repr=False)


def _layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of documents, each followed by zeros (a stride at least, then up to a whole block),
    and the first block of each document."""
    n = np.diff(offsets)
    blocks = (n + STRIDE) // (BLOCK * STRIDE) + ((n + STRIDE) % (BLOCK * STRIDE) > 0)
    first = np.cumsum(blocks) - blocks
    padded = np.zeros(int(blocks.sum()) * BLOCK * STRIDE, np.uint8)
    for at, a, b in zip((first * (BLOCK * STRIDE)).tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        padded[at : at + b - a] = data[a:b]
    return padded, first


def _windows(net: Network, padded: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Filter outputs by block: blocks x BLOCK x FILTERS. A window is two strides; the one that
    begins in the zeros at the end of a document sees nothing of the next document."""
    rows = net.embed.take(padded, axis=0).reshape(-1, STRIDE * DIM)
    out = rows @ net.filters[: STRIDE * DIM]
    late = rows @ net.filters[STRIDE * DIM :]
    late[first * BLOCK] = 0
    out[:-1] += late[1:]
    return out.reshape(-1, BLOCK, FILTERS)


def _after(n_blocks: int, first: np.ndarray) -> np.ndarray:
    """The block that follows in the same document, or the block itself."""
    later = np.arange(1, n_blocks + 1)
    later[np.append(first[1:], n_blocks) - 1] -= 1
    return later


def _combined(net: Network, pooled: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Chunks of two blocks -> hidden features of each -> their mean and maximum by document."""
    active = np.maximum(pooled + net.bias, 0)
    chunk = np.maximum(active, active[_after(len(active), first)])
    inner = np.maximum(chunk @ net.hidden + net.hidden_bias, 0)
    count = np.diff(np.append(first, len(pooled)))
    most = np.maximum.reduceat(inner, first, axis=0)
    both = np.concatenate([np.add.reduceat(inner, first, axis=0) / count[:, None], most], axis=1)
    return active, chunk, inner, count, most, both


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))


def score(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each document."""
    padded, first = _layout(data, offsets)
    # Long texts go through in pieces of whole blocks, each with the stride that follows it.
    pieces = []
    for at in range(0, len(padded), _PIECE):
        piece = padded[at : at + _PIECE + STRIDE * BLOCK]
        begins = first[(first * (BLOCK * STRIDE) >= at) & (first * (BLOCK * STRIDE) < at + len(piece))] - at // (BLOCK * STRIDE)
        pieces.append(_windows(net, piece, begins)[: _PIECE // (BLOCK * STRIDE)].max(axis=1))
    pooled = np.maximum(np.concatenate(pieces), 0) if pieces else np.zeros((0, FILTERS), np.float32)
    return _sigmoid(_combined(net, pooled, first)[-1] @ net.last + net.last_bias)


def _join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _gradient(net: Network, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    padded, first = _layout(*_join(texts))
    out = _windows(net, padded, first)
    best = out.argmax(axis=1)
    raw = np.take_along_axis(out, best[:, None], axis=1)[:, 0]
    active, chunk, inner, count, most, both = _combined(net, np.maximum(raw, 0), first)
    doc, later = np.repeat(np.arange(len(first)), count), _after(len(raw), first)
    d = ((_sigmoid(both @ net.last + net.last_bias) - labels) * weight / len(texts)).astype(np.float32)
    g = {"last": both.T @ d, "last_bias": d.sum(keepdims=True)}
    back = np.outer(d, net.last)
    to_inner = ((back[:, :HIDDEN] / count[:, None])[doc] + np.where(inner == most[doc], back[:, HIDDEN:][doc], 0)) * (inner > 0)
    g |= {"hidden": chunk.T @ to_inner, "hidden_bias": to_inner.sum(0)}
    to_chunk = to_inner @ net.hidden.T
    from_later = active[later] > active
    to_block = np.where(from_later, 0, to_chunk)
    np.add.at(to_block, later, np.where(from_later, to_chunk, 0))
    to_block *= active > 0
    g["bias"] = to_block.sum(0)
    i, f = np.nonzero(to_block * (raw > 0))
    share, at = to_block[i, f].astype(np.float32), (i * BLOCK + best[i, f]) * STRIDE
    seen = np.append(padded, np.zeros(WIDTH, np.uint8))[at[:, None] + np.arange(WIDTH)]
    windows = net.embed[seen].reshape(len(f), -1) * share[:, None]
    g["filters"] = np.zeros_like(net.filters)
    order = np.argsort(f, kind="stable")
    have, where = np.unique(f[order], return_index=True)
    if len(have):
        g["filters"][:, have] = np.add.reduceat(windows[order], where, axis=0).T
    inward = (net.filters[:, f].T * share[:, None]).reshape(-1, DIM)
    g["embed"] = np.stack([np.bincount(seen.ravel(), inward[:, k], 256) for k in range(DIM)], 1).astype(np.float32)
    return g


def learn(texts: list[bytes], labels: np.ndarray, epochs: int = 14, batch: int = 24, rate: float = 4e-3, seed: int = 7) -> Network:
    """Fit by Adam on whole texts. One class only, or no rows: a constant that says so."""
    rng = np.random.default_rng(seed)
    normal = lambda *shape, by: (rng.normal(size=shape) * by).astype(np.float32)
    net = Network(normal(256, DIM, by=0.5), normal(WIDTH * DIM, FILTERS, by=0.25), np.zeros(FILTERS, np.float32), normal(FILTERS, HIDDEN, by=0.15), np.zeros(HIDDEN, np.float32), normal(2 * HIDDEN, by=0.2), np.zeros(1, np.float32))
    net.embed[0] = 0
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        net.last[:] = 0
        net.last_bias[:] = 6 if not len(labels) or labels[0] else -6
        return net
    weight = np.ones(len(labels), np.float32)
    first = {k: np.zeros_like(getattr(net, k)) for k in net.names}
    second = {k: np.zeros_like(getattr(net, k)) for k in net.names}
    epochs = max(epochs, -(-LEAST_STEPS * batch // len(texts)))
    t, total = 0, epochs * -(-len(texts) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            some, t = order[at : at + batch], t + 1
            step = rate * min(1, t / 20) * (1 - t / (total + 1))
            for k, g in _gradient(net, [texts[i] for i in some], labels[some], weight[some]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                way = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-7)
                setattr(net, k, (getattr(net, k) - step * way).astype(np.float32))
            net.embed[0] = 0
    return net


def held_out(id_col: str = "doc_id"):
    """Rows that learning must not see; a null id is none of them (and never learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS, sample_text_bytes: int = SAMPLE_TEXT_BYTES) -> Network:
    """Learn from at most sample_rows labelled rows that are not held out, chosen by a hash of
    the id; labels of one id that differ count as 0.  Texts over sample_text_bytes are left out
    of the sample (never of scoring)."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(label_col).alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample_rows)
    )
    rows = (
        docs.select(F.col(id_col).alias("__id"), F.coalesce(text_col, F.lit("")).alias("__text"))
        .where(F.octet_length("__text") <= sample_text_bytes)
        .join(F.broadcast(chosen), "__id")
        .select("__id", "__label", F.encode("__text", "utf-8").alias("__text"))
        .toArrow()
        .sort_by("__id")
    )
    return learn([bytes(x) for x in rows.column("__text").to_pylist()], np.array(rows.column("__label").to_pylist(), np.float32))


def classify(docs: DataFrame, net: Network, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep``, score and predicted of every row.

    Null and empty texts are scored as an empty text; rows that repeat are scored each; an empty
    table gives an empty result; columns called like ours are left out unless kept.
    """
    # The text goes to the tasks once, whether it is kept or not.
    own = [F.col(f"`{c}`") for c in keep]
    picked = bounded(docs).select(*own, *([] if text_col in keep else [F.col(f"`{text_col}`").alias("__text")]))
    text_at = keep.index(text_col) if text_col in keep else len(keep)
    sent = docs.sparkSession.sparkContext.broadcast(net)  # some 50 kB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(sent.value, data, offsets) for _, _, data, offsets in steps(batch, text_at, _STEP)]
            s = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    fields = ", ".join(f"`{c}` {t}" for c, t in picked.select(*own).dtypes)
    return picked.mapInArrow(run, f"{fields + ', ' if fields else ''}score double, predicted int")


def score_texts(net: Network, texts: list[str]) -> np.ndarray:
    return score(net, *text_buffers(pa.array(texts, pa.string()))) if texts else np.zeros(0)
