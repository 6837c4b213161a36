"""A minimal perfect hash over 64-bit keys: cascaded bit arrays with ranks.

At each level the keys left choose a bit; bits that one key chose are set, the
other keys go on to the next level.  A key's slot is the rank of its bit among
all set bits, so slots are 0 .. n-1 without gaps; about 3 bits a key are stored.
"""

from __future__ import annotations

import numpy as np

from jobsight.llm.words import U, mix

#: Bits of a level for each key that reaches it.
ROOM = 1.6
#: Of distinct keys at least one in 64 ever stays behind at a level; this many are never reached.
MOST_LEVELS = 256


def place(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (mix(keys + U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % U(bits)).astype(np.int64)


class PerfectHash:
    """``sizes``: bits of each level, multiples of 64; ``words``: all levels' bits."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Over distinct keys; raises if keys repeat."""
        sizes, levels = [], []
        while len(keys):
            if len(levels) == MOST_LEVELS:
                raise ValueError("keys repeat")
            bits = -(-max(64, int(ROOM * len(keys))) // 64) * 64
            at = place(keys, len(levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            sizes.append(bits)
            levels.append(np.packbits(alone, bitorder="little").view(U))
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.empty(0, U))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 or any slot for keys that were not built in."""
        out = np.full(len(keys), -1, np.int64)
        left, first = np.arange(len(keys)), 0
        for level, bits in enumerate(self.sizes):
            if not len(left):
                break
            at = place(keys[left], level, int(bits))
            word, bit = first + (at >> 6), (at & 63).astype(U)
            found = (self.words[word] >> bit) & U(1) == 1
            w, b = word[found], bit[found]
            out[left[found]] = self.before[w] + np.bitwise_count(self.words[w] & ((U(1) << b) - U(1)))
            left, first = left[~found], first + int(bits) // 64
        return out
