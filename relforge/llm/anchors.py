"""Winnowed anchors of byte strings: routing keys for repeated 100-byte strings.

Each run of ``LENGTH`` bytes (a window) owns one anchor, the leftmost smallest 24-byte gram hash in
it. Equal windows own equal anchors at the same offset, so equal windows can be brought together by
their anchor, and neighbouring windows that own the same anchor travel as one span.
"""

from __future__ import annotations

import numpy as np

LENGTH = 100
_GRAM = 24
_WIN = LENGTH - _GRAM + 1
_PIECE = 1 << 20
_LOW = np.uint64(_PIECE * 2 - 1)
_RNG = np.random.default_rng(1010)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULS = [np.uint64(int(x) | 1) for x in _RNG.integers(2**62, 2**63, 6)]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each 24-byte gram, by doubling (1, 2, 4, 8) and one join of three 8s."""
    h = _BYTE[data]
    for step, mul in ((1, _MULS[0]), (2, _MULS[1]), (4, _MULS[2])):
        h = (h[:-step] * mul) + h[step:]
        h ^= h >> np.uint64(31)
    h = (h[:-16] * _MULS[3] + h[8:-8]) * _MULS[4] + h[16:]
    h ^= h >> np.uint64(32)
    h *= _MULS[5]
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values: prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    square = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window start, number of windows, anchor offset in the first window).

    The spans of a byte string cover each window start exactly once. Long strings are taken in
    pieces of 1 MiB of window starts; a window at a piece's edge sees the same bytes either way.
    """
    total = len(data) - LENGTH + 1
    parts = []
    raw = np.frombuffer(data, np.uint8)
    for lo in range(0, max(total, 0), _PIECE):
        n = min(_PIECE, total - lo)
        h = _gram_hashes(raw[lo : lo + n + LENGTH - 1])
        least = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), _WIN) & _LOW
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        at = least[first].astype(np.int64)
        parts.append((h[at].view(np.int64), first + lo, np.diff(np.append(first, n)), at - first))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
