"""The classifier's probability by plain loops over the bytes."""

import math

import numpy as np
import pytest

from tallybridge.llm import quality


def _network(seed):
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.normal(size=shape) * 0.4).astype(np.float32)
    return quality.Network(normal(256, quality.DIM), normal(quality.WIDTH * quality.DIM, quality.FILTERS), normal(quality.FILTERS), normal(quality.FILTERS, quality.HIDDEN), normal(quality.HIDDEN), normal(2 * quality.HIDDEN) * 0.1, normal(1))


def _probability(net, text: bytes) -> float:
    """Windows of 8 bytes at every 4th byte, half chunks of 64 windows, chunks of two halves, mean and maximum over the chunks."""
    half = quality.BLOCK * quality.STRIDE
    n_halves = -(-(len(text) + quality.STRIDE) // half)
    padded = text + bytes(n_halves * half - len(text))
    pooled = []
    for h in range(n_halves):
        best = [0.0] * quality.FILTERS
        for w in range(quality.BLOCK):
            at = h * half + w * quality.STRIDE
            seen = [0.0] * quality.FILTERS
            for place in range(quality.WIDTH):
                if at + place >= len(padded):
                    break  # behind the zeros that close the text there is nothing
                for d in range(quality.DIM):
                    x = float(net.embed[padded[at + place], d])
                    for f in range(quality.FILTERS):
                        seen[f] += x * float(net.filters[place * quality.DIM + d, f])
            best = [max(a, b) for a, b in zip(best, seen, strict=True)]
        pooled.append([max(0.0, b + float(net.bias[f])) for f, b in enumerate(best)])
    inner = []
    for h in range(n_halves):
        chunk = [max(a, b) for a, b in zip(pooled[h], pooled[min(h + 1, n_halves - 1)], strict=True)]
        inner.append([max(0.0, sum(chunk[f] * float(net.hidden[f, j]) for f in range(quality.FILTERS)) + float(net.hidden_bias[j])) for j in range(quality.HIDDEN)])
    both = [sum(i[j] for i in inner) / n_halves for j in range(quality.HIDDEN)] + [max(i[j] for i in inner) for j in range(quality.HIDDEN)]
    return 1 / (1 + math.exp(-(sum(b * float(w) for b, w in zip(both, net.last, strict=True)) + float(net.last_bias[0]))))


@pytest.mark.parametrize("piece", [quality._PIECE, 256])
def test_probability_is_that_of_plain_loops(monkeypatch, piece):
    monkeypatch.setattr(quality, "_PIECE", piece)
    rng = np.random.default_rng(1)
    texts = [b"", b"a", bytes(rng.integers(0, 256, 251).astype(np.uint8)), "straße und café ".encode() * 16, bytes(rng.integers(97, 123, 253).astype(np.uint8)), bytes(rng.integers(32, 127, 700).astype(np.uint8))]
    net = _network(3)
    got = quality.score(net, *quality._join(texts))
    want = [_probability(net, t) for t in texts]
    assert np.allclose(got, want, atol=2e-5) and len({round(x, 4) for x in want}) > 4
