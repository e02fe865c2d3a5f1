"""A minimal perfect hash over 128-bit keys: n keys to the places 0 to n-1, each its own.

Levels of bit arrays: a key that no other key shares a bit with is settled at that level, the others go
on to the next. A settled key's place is the number of set bits before its own. About four bits a key.
"""

from __future__ import annotations

import struct

import numpy as np

from signalwatch.llm.common import mix

GAMMA = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _bits(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = mix(a + _STEP * np.uint64(2 * level + 1)) ^ mix(b ^ (_STEP * np.uint64(2 * level + 2)))
        return (mix(h) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``levels`` are arrays of bits, eight to a byte."""

    def __init__(self, sizes: list[int], levels: list[np.ndarray]):
        self.sizes, self.levels = sizes, levels
        self.counts = [
            np.concatenate([[0], np.cumsum(np.bitwise_count(x).astype(np.int64))]) for x in levels
        ]
        self.before = np.cumsum([0, *(int(c[-1]) for c in self.counts)])

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        """For distinct keys, each a pair of 64-bit numbers."""
        a, b = a.astype(np.uint64), b.astype(np.uint64)
        sizes, levels = [], []
        while len(a):
            if len(levels) > 200:
                raise ValueError("keys repeat")
            size = max(64, GAMMA * len(a))
            at = _bits(a, b, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        return cls(sizes, levels)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the keys; -1 for some keys that are not in the set, any place for others."""
        a, b = a.astype(np.uint64), b.astype(np.uint64)
        out = np.full(len(a), -1, np.int64)
        open_ = np.arange(len(a))
        for level, (size, bits) in enumerate(zip(self.sizes, self.levels, strict=True)):
            if not len(open_):
                break
            at = _bits(a[open_], b[open_], level, size)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(bits[byte] & ((np.uint8(1) << bit) - np.uint8(1)))
            out[open_[hit]] = (self.before[level] + self.counts[level][byte] + below)[hit]
            open_ = open_[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.sizes)) + struct.pack(f"<{len(self.sizes)}Q", *self.sizes)
        return head + b"".join(x.tobytes() for x in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        [n] = struct.unpack_from("<I", raw)
        sizes, at, levels = list(struct.unpack_from(f"<{n}Q", raw, 4)), 4 + 8 * n, []
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.frombuffer(raw, np.uint8, width, at))
            at += width
        return cls(sizes, levels)
