"""Static 3-wise binary-fuse filter with 8-bit fingerprints, built and probed
with vectorised numpy.  A filter is immutable: it is built once from the
distinct 64-bit keys of one shard of a snapshot and travels as bytes."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QIII")   # seed, segment length, segment count, number of keys
_TRIES = 64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser (murmur-style) of key + seed."""
    with np.errstate(over="ignore"):
        h = x + np.uint64(seed)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def _cells(h: np.ndarray, seg_len: int, seg_count: int) -> np.ndarray:
    """The three cells of each hash, in three neighbouring segments."""
    first = (h >> np.uint64(40)) * np.uint64(seg_count) >> np.uint64(24)
    base = first.astype(np.int64) * seg_len
    mask = np.uint64(seg_len - 1)
    offs = [(h & mask), (h >> np.uint64(13)) & mask, (h >> np.uint64(26)) & mask]
    return np.stack([base + k * seg_len + o.astype(np.int64) for k, o in enumerate(offs)])


def _prints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> bytes:
    """Filter of distinct uint64 ``keys`` (empty: a filter that rejects all)."""
    keys = np.unique(np.asarray(keys, dtype=np.uint64))
    n = len(keys)
    if n == 0:
        return _HEAD.pack(0, 0, 0, 0)
    seg_len = 1 << min(13, max(2, int(np.log(n) / np.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
    for seed in range(1, _TRIES + 1):
        seg_count = max(1, int(np.ceil(n * factor / seg_len)) - 2 + seed // 8)
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))
        cells = _cells(h, seg_len, seg_count)
        order = _peel(cells, (seg_count + 2) * seg_len)
        if order is not None:
            table = np.zeros((seg_count + 2) * seg_len, dtype=np.uint8)
            prints = _prints(h)
            for rows, owned in reversed(order):  # keys peeled in one round own distinct cells
                a, b, c = cells[:, rows]
                table[owned] = 0
                table[owned] = prints[rows] ^ table[a] ^ table[b] ^ table[c]
            return _HEAD.pack(seed * 0x9E3779B97F4A7C15 & (2 ** 64 - 1), seg_len, seg_count, n) + table.tobytes()
    raise RuntimeError("no seed peels this key set")


def _peel(cells: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the cell each key owns), or None if a core remains."""
    n = cells.shape[1]
    degree = np.bincount(cells.ravel(), minlength=size)
    # xor of the key numbers in a cell names the last key left in it
    which = np.zeros(size, dtype=np.int64)
    for row in cells:
        np.bitwise_xor.at(which, row, np.arange(n))
    rounds: list[tuple[np.ndarray, np.ndarray]] = []
    left = n
    while left:
        lone = np.flatnonzero(degree == 1)  # such a cell belongs to one key left, so a round's keys are independent
        if not len(lone):
            return None
        rows, at = np.unique(which[lone], return_index=True)
        owned = lone[at]
        rounds.append((rows, owned))
        left -= len(rows)
        for row in cells[:, rows]:
            np.subtract.at(degree, row, 1)
            np.bitwise_xor.at(which, row, rows)
    return rounds


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """Which ``keys`` may be in the filter (no false negatives)."""
    seed, seg_len, seg_count, n = _HEAD.unpack_from(blob)
    keys = np.asarray(keys, dtype=np.uint64)
    if n == 0:
        return np.zeros(len(keys), dtype=bool)
    table = np.frombuffer(blob, dtype=np.uint8, offset=_HEAD.size)
    h = _mix(keys, seed)
    a, b, c = _cells(h, seg_len, seg_count)
    return (table[a] ^ table[b] ^ table[c]) == _prints(h)
