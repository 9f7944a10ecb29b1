"""Minimal perfect hashing of distinct integers by levels of bit vectors.

At each level the keys left are hashed into a bit vector of ``GAMMA`` places a
key; a key alone in its place keeps it, the others go on to the next level.  A
key's index is the number of places kept before its own, so n keys get 0 to n - 1.
A key that is not in the set may get an index too, or -1: callers keep the keys in
index order and compare.
"""

from __future__ import annotations

import numpy as np

from .arrays import mix

GAMMA = 2
_MOST_LEVELS = 200


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(mix(keys) + np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> list[bytes]:
    """The levels for distinct non-negative integers."""
    left, levels = keys.astype(np.uint64), []
    while len(left):
        if len(levels) == _MOST_LEVELS:
            raise ValueError("keys are not distinct")
        size = -(-GAMMA * len(left) // 8) * 8
        at = _places(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(np.packbits(alone).tobytes())
        left = left[~alone[at]]
    return levels


def lookup(levels: list[bytes], keys: np.ndarray) -> np.ndarray:
    """Index of every key; -1 for some that are not in the set."""
    keys = keys.astype(np.uint64)
    out, todo, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
    for level, bits in enumerate(levels):
        if not len(todo):
            break
        alone = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        kept = np.cumsum(alone)
        at = _places(keys[todo], level, len(alone))
        hit = alone[at]
        out[todo[hit]] = base + kept[at[hit]] - 1
        todo, base = todo[~hit], base + int(kept[-1])
    return out
