"""Content-defined anchors: in every run of `span` bytes the leftmost least of
all `gram`-byte hashes. The choice depends on these bytes alone, so equal runs
hold an anchor at the same place wherever they occur."""

from __future__ import annotations

import numpy as np

GRAM = 128
PIECE = 1 << 20
_P = 0x9E3779B1


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hash of every run of `gram` bytes (a power of two), by doubling."""
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    p, k = _P, 1
    while k < gram:
        h = h[:-k] * np.uint32(p) + h[k:]
        p, k = p * p & 0xFFFFFFFF, k * 2
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(13)
    return h


def _least(data: np.ndarray, span: int, gram: int) -> np.ndarray:
    """For every run of `span` bytes, the place of its leftmost least hash."""
    w = span - gram + 1
    key = gram_hashes(data, gram).astype(np.uint64) << np.uint64(32) | np.arange(len(data) - gram + 1, dtype=np.uint64)
    n = len(key) - w + 1
    padded = np.full(-(-len(key) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:len(key)] = key
    rows = padded.reshape(-1, w)
    right = np.minimum.accumulate(rows, axis=1).ravel()
    left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(left[:n], right[w - 1:w - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, starts: np.ndarray, span: int, gram: int = GRAM) -> np.ndarray:
    """Places of all anchors in `data`, texts laid end to end at `starts`.
    Runs that reach over the end of a text choose nothing."""
    ends = np.append(starts[1:], len(data))
    long = ends - starts >= span
    whole = np.zeros(len(data) + 1, np.int32)
    np.add.at(whole, starts[long], 1)
    np.add.at(whole, ends[long] - span + 1, -1)
    whole = np.cumsum(whole) > 0
    found = [np.zeros(0, np.int64)]
    for at in range(0, len(data) - span + 1, PIECE):
        part = data[at:at + PIECE + span - 1]
        least = _least(part, span, gram) + at
        found.append(least[whole[at:at + len(least)]])
    least = np.concatenate(found)
    # runs move on, so equal places stand together
    return least[np.append(True, least[1:] != least[:-1])] if len(least) else least
