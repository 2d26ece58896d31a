"""Signature tree over shingle sets: exact similarity links by dual traversal.

Leaves hold documents, inner nodes the OR of their bitmaps, the range of their set sizes
and the least number of bits.  A pair of nodes is pruned if its sizes are too far apart,
if no two documents below it can overlap enough, or if all documents below it are in one
component already.
"""

from __future__ import annotations

import numpy as np

#: Similarity as a fraction: linked if PERCENT * union <= 100 * intersection.
PERCENT = 80
FANOUT = 8


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits a set, twice to four times as many bits as the largest set has tokens."""
    most = max(len(s) for s in sets)
    bits = max(512, 1 << (2 * most - 1).bit_length())
    out = np.empty((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        row = np.zeros(bits, np.bool_)
        row[s & np.int64(bits - 1)] = True
        out[i] = np.packbits(row).view(np.uint64)
    return out


class Tree:
    """Levels from the documents (0) to the root; node k covers children k*FANOUT ..."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        b = _bitmaps(sets)
        pop = np.bitwise_count(b).sum(1, dtype=np.int64)
        self.levels = [(b, sizes, sizes, pop)]
        while len(self.levels[-1][1]) > 1:
            b, low, high, pop = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, cut, axis=0), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.minimum.reduceat(pop, cut)))

    def may_link(self, level: int, xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        """Of all pairs of the nodes xs and ys of a level: may documents below them link?"""
        b, low, high, pop = self.levels[level]
        common = np.bitwise_count(b[xs][:, None, :] & b[ys][None, :, :]).sum(2, dtype=np.int64)
        # bits that the other side lacks are tokens that it lacks
        most = np.minimum((high[xs] - pop[xs])[:, None] + np.minimum(common, pop[xs][:, None]),
                          (high[ys] - pop[ys])[None, :] + np.minimum(common, pop[ys][None, :]))
        least_sum = low[xs][:, None] + low[ys][None, :]
        near = ((100 * high[xs][:, None] >= PERCENT * low[ys][None, :])
                & (100 * high[ys][None, :] >= PERCENT * low[xs][:, None]))
        return near & ((100 + PERCENT) * most >= PERCENT * least_sum)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def link(sets: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """Component of each set: sets of one ``label`` are joined beforehand; links join the rest.

    ``sets`` are sorted arrays of distinct int64 tokens, none empty.  Every pair in
    different components is either checked exactly or pruned by a bound that holds.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((sizes, np.array([s[0] for s in sets])))  # alike documents side by side
    sets, sizes = [sets[i] for i in order], sizes[order]
    root = np.unique(label[order], return_inverse=True)[1].reshape(-1)
    if root.max(initial=0) > 0:
        tree = Tree(sets, sizes)
        stack = [(len(tree.levels) - 1, 0, 0)]
        while stack:
            level, x, y = stack.pop()
            span = FANOUT ** level
            rx, ry = root[x * span:(x + 1) * span], root[y * span:(y + 1) * span]
            if (rx == rx[0]).all() and (ry == rx[0]).all():
                continue
            if level == 0:
                if linked(sets[x], sets[y]):
                    root[root == root[y]] = root[x]
                continue
            below = len(tree.levels[level - 1][1])
            xs = np.arange(x * FANOUT, min((x + 1) * FANOUT, below))
            ys = np.arange(y * FANOUT, min((y + 1) * FANOUT, below))
            may = tree.may_link(level - 1, xs, ys)
            pairs = [(int(xs[i]), int(ys[j])) for i, j in zip(*np.nonzero(may))]
            if x == y:
                pairs = [(i, j) for i, j in pairs if i < j or i == j and level > 1]
            pairs.sort(key=lambda p: p[0] == p[1])  # pairs of a node with itself are on top
            stack += [(level - 1, i, j) for i, j in pairs]
    out = np.empty(len(order), np.int64)
    out[order] = root
    return out
