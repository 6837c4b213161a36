"""Run-length grammars by recompression, and how far two places of a sequence agree.

Levels alternate.  Block compression names maximal blocks of one symbol by
(symbol, count); pair compression halves the symbols by a hash, and names every
adjacent pair of a left and a right symbol.  Equal stretches are parsed alike
but for their borders, so two places are compared by climbing to the highest
level at which both begin equal symbols, skipping those, and falling back to the
symbols below where they differ: a number of steps that grows with the logarithm
of the agreement.  Blocks of different counts are skipped by the smaller count.

Levels end when no symbol repeats.  Many queries are answered together.
"""

from __future__ import annotations

import numpy as np

from jobsight.llm.words import U, mix


class Grammar:
    """Parse of ``symbols`` (non-negative), whose first and last must occur nowhere else.

    The levels lie one behind the other in flat arrays; the symbols themselves are
    level 0, so a place's index is its position.
    """

    def __init__(self, symbols: np.ndarray):
        level = symbols.astype(np.int64)
        count = int(level.max()) + 1
        size = np.ones(len(level), np.int64)
        names, sizes, ups, downs, blocks = [], [], [], [np.full(len(level), -1, np.int64)], []
        first = 0  # index of this level's first symbol
        rounds = still = 0
        while still < 64 and np.bincount(level, minlength=1).max() > 1:
            by_block = rounds % 2 == 0
            rounds += 1
            if by_block:
                heads = np.flatnonzero(np.concatenate([[True], level[1:] != level[:-1]]))
                width = np.diff(np.append(heads, len(level)))
                above, merged = level[heads], np.flatnonzero(width > 1)
                key = above[merged] * (len(level) + 1) + width[merged]
            else:
                right = mix(level.view(U) + U(rounds)) & U(1) == 1
                pairs = ~right[:-1] & right[1:]
                stays = np.concatenate([[True], ~pairs])
                heads = np.flatnonzero(stays)
                above, merged = level[heads], np.flatnonzero(np.append(pairs, False)[heads])
                key = above[merged] * count + level[heads[merged] + 1]
            if not len(merged):
                still += 1
                continue
            still = 0
            distinct, name = np.unique(key, return_inverse=True)
            above[merged] = count + name
            count += len(distinct)
            begins = np.zeros(len(level), np.int64)
            begins[heads] = 1
            names.append(level)
            sizes.append(size)
            blocks.append(np.full(len(level), by_block))
            ups.append(first + len(level) + np.cumsum(begins) - 1)
            downs.append(first + heads)
            size = np.add.reduceat(size, heads)
            first += len(level)
            level = above
        names.append(level)
        sizes.append(size)
        blocks.append(np.zeros(len(level), bool))
        ups.append(np.full(len(level), -1, np.int64))
        self.name, self.size = np.concatenate(names), np.concatenate(sizes)
        self.up, self.by_block = np.concatenate(ups), np.concatenate(blocks)
        #: First symbol below; the one of the next index ends a symbol's children.
        self.down = np.append(np.concatenate(downs), first)

    def agree(self, x: np.ndarray, y: np.ndarray, forward: bool = True) -> np.ndarray:
        """Symbols in common from positions x < y on, to the right or (both included) to the left."""
        name, up, down = self.name, self.up, self.down
        total = np.zeros(len(x), np.int64)
        left, a, b = np.arange(len(x)), x.copy(), y.copy()
        border = (lambda p: down[p]) if forward else (lambda p: down[p + 1] - 1)
        while len(left):
            same = name[a] == name[b]
            pa, pb = up[a], up[b]
            climb = same & (pa >= 0) & (border(pa) == a) & (border(pb) == b) & (name[pa] == name[pb])
            skip = same & ~climb
            if skip.any():
                s = np.flatnonzero(skip)
                t = np.ones(len(s), np.int64)
                inside = np.flatnonzero(self.by_block[a[s]])
                i = s[inside]
                if forward:
                    t[inside] = np.minimum(down[pa[i] + 1] - a[i], down[pb[i] + 1] - b[i])
                else:
                    t[inside] = np.minimum(a[i] - down[pa[i]], b[i] - down[pb[i]]) + 1
                total[left[s]] += t * self.size[a[s]]
                step = t if forward else -t
                a[s] += step
                b[s] += step
            a, b = np.where(climb, pa, a), np.where(climb, pb, b)
            over = ~same & (down[a] < 0)  # nothing below: the symbols themselves differ
            below = ~same & ~over
            a, b = np.where(below, border(a), a), np.where(below, border(b), b)
            if over.any():
                left, a, b = left[~over], a[~over], b[~over]
        return total
