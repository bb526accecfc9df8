"""Three-wise binary fuse filters over 64-bit keys, built and probed on whole arrays.

After Graf and Lemire, "Binary Fuse Filters: Fast and Smaller Than Xor Filters" (2022)."""

from __future__ import annotations

import math

import numpy as np


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser; ``keys`` is uint64."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def _slots(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray:
    first = ((h >> np.uint64(32)) * np.uint64(seg_len * seg_count)) >> np.uint64(32)
    mask = np.uint64(seg_len - 1)
    second = (first + np.uint64(seg_len)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * seg_len)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build(keys: np.ndarray, max_tries: int = 64) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, fingerprints) of distinct keys."""
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    seg_len = min(1 << 18, 1 << max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    seg_count = max(1, math.ceil(n * factor / seg_len) - 2)
    for seed in range(1, max_tries + 1):
        prints = _peel(mix(keys, seed), seg_len, seg_count)
        if prints is not None:
            return seed, seg_len, seg_count, prints.tobytes()
        if seed % 8 == 0:  # tiny sets are unlucky now and then: give them room
            seg_count += 1
    raise RuntimeError("no filter found for these keys")


def _peel(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray | None:
    size = (seg_count + 2) * seg_len
    slots = _slots(h, seg_len, seg_count)
    n = len(h)
    count = np.bincount(slots.ravel(), minlength=size)
    owner = np.zeros(size, np.int64)  # xor of the keys in a slot: the key itself where one is left
    for row in slots:
        np.bitwise_xor.at(owner, row, np.arange(n))
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    queue = np.flatnonzero(count == 1)
    left = n
    while len(queue):
        keys, first = np.unique(owner[queue], return_index=True)
        own = queue[first]
        layers.append((keys, own))
        left -= len(keys)
        touched = slots[:, keys]
        for row in touched:
            np.subtract.at(count, row, 1)
            np.bitwise_xor.at(owner, row, keys)
        near = np.unique(touched)
        queue = near[count[near] == 1]
    if left:
        return None
    prints = np.zeros(size, np.uint8)
    want = _prints(h)
    for keys, own in reversed(layers):
        a, b, c = slots[:, keys]
        prints[own] = want[keys] ^ prints[a] ^ prints[b] ^ prints[c] ^ prints[own]
    return prints


def contains(keys: np.ndarray, seed: int, seg_len: int, seg_count: int, prints: bytes) -> np.ndarray:
    """True for every key of the set, and for about one in 256 others."""
    h = mix(keys.astype(np.uint64), seed)
    a, b, c = _slots(h, seg_len, seg_count)
    table = np.frombuffer(prints, np.uint8)
    return _prints(h) == (table[a] ^ table[b] ^ table[c])
