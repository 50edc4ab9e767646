"""R-tree over count vectors, bulk-loaded by sort-tile-recursive packing.

A point is the vector of group counts of a set: how many of its elements hash
into each group. Two sets share at most the sum of the coordinate minima of
their points, and a set shares at most the sum of the minima of its point and
a box's upper corner with any set inside the box.
"""

from __future__ import annotations

import numpy as np

GROUPS = 32
LEAF = 16
FANOUT = 8
#: A stored count of this value means "this many or more": it bounds nothing.
MANY = 255


def count_vectors(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts, GROUPS) group counts of each text's elements, capped at MANY."""
    owner = np.repeat(np.arange(len(counts)), counts)
    group = (elements >> np.uint64(59)).astype(np.int64)  # GROUPS == 32
    flat = np.bincount(owner * GROUPS + group, minlength=len(counts) * GROUPS)
    return np.minimum(flat, MANY).astype(np.uint8).reshape(-1, GROUPS)


def as_bounds(vectors: np.ndarray) -> np.ndarray:
    out = vectors.astype(np.float32)
    out[vectors == MANY] = np.inf
    return out


def least_overlap(a, b):
    """Elements two sets of these sizes must share for a Jaccard similarity of 0.8."""
    return -(-4 * (a + b) // 9)


def sizes_fit(a, b):
    return 5 * np.minimum(a, b) >= 4 * np.maximum(a, b)


class RTree:
    """Points with their set sizes; nodes hold the upper corner and the sizes' range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = self._pack(np.arange(len(points)))
        self.levels = []
        lo, hi, top = sizes[self.order], sizes[self.order], points[self.order]
        span = LEAF
        while True:
            cuts = np.arange(0, len(top), span)
            top, lo, hi = np.maximum.reduceat(top, cuts), np.minimum.reduceat(lo, cuts), np.maximum.reduceat(hi, cuts)
            self.levels.append((top, lo, hi))
            if len(top) == 1:
                return
            span = FANOUT

    def _pack(self, rows: np.ndarray) -> np.ndarray:
        """Order in which neighbours share leaves: by size, then tiles by the
        coordinates that vary most."""
        if len(rows) <= LEAF:
            return rows
        rows = rows[np.argsort(self.sizes[rows], kind="stable")]
        finite = np.where(np.isinf(self.points), MANY, self.points)
        dims = np.argsort(-finite[rows].var(axis=0))[:2]
        leaves = -(-len(rows) // LEAF)
        strips = max(1, round(leaves ** (1 / 3)))
        out = []
        for part in np.array_split(rows, strips):
            part = part[np.argsort(finite[part, dims[0]], kind="stable")]
            for tile in np.array_split(part, strips):
                out.append(tile[np.argsort(finite[tile, dims[1]], kind="stable")])
        return np.concatenate(out)

    def query(self, point: np.ndarray, size: int) -> np.ndarray:
        """Rows whose sizes and summed minima allow a similarity of 0.8."""
        nodes = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, lo, hi = self.levels[depth]
            ok = (5 * hi[nodes] >= 4 * size) & (4 * lo[nodes] <= 5 * size)
            nodes = nodes[ok]
            ok = np.minimum(top[nodes], point).sum(axis=1) >= least_overlap(size, lo[nodes])
            nodes = nodes[ok]
            step = LEAF if depth == 0 else FANOUT
            below = len(self.points) if depth == 0 else len(self.levels[depth - 1][0])
            nodes = (nodes[:, None] * step + np.arange(step)).ravel()
            nodes = nodes[nodes < below]
        rows = self.order[nodes]
        ok = sizes_fit(self.sizes[rows], size)
        rows = rows[ok]
        return rows[np.minimum(self.points[rows], point).sum(axis=1) >= least_overlap(self.sizes[rows], size)]
