"""Keyed permutations of 0..n-1: a Feistel network on the next even power of two, with cycle-walking."""

from __future__ import annotations

import numpy as np

from sightline.llm.words import mix

ROUNDS = 6


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each x (0 <= x < n) in the permutation of ``key``; n up to 2**62.

    Values that the network sends to n or above are sent through it again until they
    are below. The network is one to one, so they end, and no two meet; under four
    rounds are needed on average.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(key % (1 << 64)))

    def network(v: np.ndarray) -> np.ndarray:
        left, right = v >> half, v & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        return (left << half) | right

    out = network(np.asarray(x).astype(np.uint64))
    outside = np.flatnonzero(out >= np.uint64(n))
    while len(outside):
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)
