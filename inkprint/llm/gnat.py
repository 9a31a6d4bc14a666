"""A multiway hyperplane tree over integer vectors, with distance ranges between siblings.

A node has up to ``FANOUT`` split points, far from each other; a row belongs to the nearest one's subtree. For every
split point and every sibling subtree the node keeps the least and greatest distance from the one to the rows of the other.
A query wants rows whose inner product lies in a window; with the norms of a subtree's rows the window is an annulus
of distances around the query. By the triangle inequality a subtree holds no such row when the annulus misses
[range shifted by the query's distance to any split point]; such subtrees are eliminated.

The tree is fitted on a bounded sample. It holds a bounded number of points and ranges, so it travels with the job.
"""

from __future__ import annotations

import numpy as np

from inkprint.functions.shipping import ship_with_job

ship_with_job(__name__)

FANOUT, DEPTH, LEAF_ROWS = 16, 2, 48
#: Distances are compared with this much slack, relative to their size, so that rounding eliminates nothing.
SLACK = 1e-9


def _far_points(rows: np.ndarray, k: int) -> np.ndarray:
    """Up to k different rows, each the farthest from those before it."""
    chosen = [int(np.argmax(((rows - rows.mean(0)) ** 2).sum(1)))]
    far = ((rows - rows[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
    return rows[chosen]


class Tree:
    """``nodes``: (points, children); a child is (True, leaf number) or (False, node number)."""

    def __init__(self, sample: np.ndarray):
        self.nodes: list[tuple[np.ndarray, list[tuple[bool, int]]]] = []
        self.paths: list[list[tuple[int, int]]] = []
        self.ranges: dict[tuple[int, int, int], tuple[float, float]] = {}
        self.norms: dict[int, tuple[float, float]] = {}
        self._grow(sample.astype(np.float64), DEPTH, [])

    def _grow(self, rows: np.ndarray, depth: int, path: list[tuple[int, int]]) -> tuple[bool, int]:
        points = _far_points(rows, FANOUT) if depth and len(rows) > LEAF_ROWS else rows[:0]
        if len(points) < 2:
            if path:
                self.paths.append(path)
                return True, len(self.paths) - 1
            points = rows[:1] if len(rows) else np.zeros((1, rows.shape[1]))  # one leaf below the root
        number = len(self.nodes)
        self.nodes.append((points, []))
        nearest = distances(rows, points).argmin(1) if len(points) > 1 else np.zeros(len(rows), int)
        for j in range(len(points)):
            below = depth - 1 if len(points) > 1 else 0
            self.nodes[number][1].append(self._grow(rows[nearest == j], below, [*path, (number, j)]))
        return False, number

    @property
    def n_leaves(self) -> int:
        return len(self.paths)

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int, int], tuple[float, float]]]:
        """Leaf of every row, and the (node, point, child) distance ranges of these rows."""
        leaves, ranges, todo = np.zeros(len(rows), np.int64), {}, [(0, np.arange(len(rows)))]
        while todo:
            number, at = todo.pop()
            points, children = self.nodes[number]
            d = distances(rows[at], points)
            nearest = d.argmin(1)
            for j, (is_leaf, below) in enumerate(children):
                own = nearest == j
                if own.any():
                    for i, (low, high) in enumerate(zip(d[own].min(0), d[own].max(0))):
                        ranges[number, i, j] = (float(low), float(high))
                    if is_leaf:
                        leaves[at[own]] = below
                    else:
                        todo.append((below, at[own]))
        return leaves, ranges

    def describe(self, ranges: dict[tuple[int, int, int], tuple[float, float]], norms: dict[int, tuple[float, float]]) -> None:
        """Take the ranges between siblings and the squared norms of each leaf's rows, over all rows."""
        self.ranges, self.norms = ranges, norms

    def point_distances(self, queries: np.ndarray) -> list[np.ndarray]:
        return [distances(queries, points) for points, _ in self.nodes]

    def survives(self, leaf: int, to_points: list[np.ndarray], norm2: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which queries (squared norm, inner products wanted from low to high) may find a row in the leaf."""
        if leaf not in self.norms:
            return np.zeros(len(norm2), bool)
        least, most = self.norms[leaf]
        outer = np.sqrt(np.maximum(0, norm2 + most - 2 * low))
        inner = np.sqrt(np.maximum(0, norm2 + least - 2 * high))
        alive = (low <= high) & (norm2 + most - 2 * low >= 0)
        for number, j in self.paths[leaf]:
            d = to_points[number]
            for i in range(d.shape[1]):
                a, b = self.ranges[number, i, j]
                slack = SLACK * (1 + d[:, i] + b)
                alive &= (np.maximum(a - d[:, i], d[:, i] - b) <= outer + slack) & (d[:, i] + b >= inner - slack)
        return alive

    def nearest(self, leaves: list[int], to_points: list[np.ndarray]) -> np.ndarray:
        """Place, among ``leaves``, of the one whose own split point is nearest to each query."""
        return np.stack([to_points[self.paths[leaf][-1][0]][:, self.paths[leaf][-1][1]] for leaf in leaves], 1).argmin(1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to the few rows of b, without a difference of large squares."""
    out = np.empty((len(a), len(b)))
    for k, point in enumerate(b):
        out[:, k] = np.sqrt(((a - point) ** 2).sum(1))
    return out
