"""A multiway hyperplane tree over whole-number vectors, with distance ranges at every split point.

A node has a few split points; a row belongs to the child of its nearest one, so
children are separated by hyperplanes half way between split points.  For every
split point and every child of the node the tree knows the least and greatest
distance from the point to the rows below that child.  A query at distance ``d``
from a split point can find rows at distances ``r1`` to ``r2`` from itself below
a child only if ``[r1 - d, d + r2]`` (and the triangle the other way round) meets
that range, so one distance rules out whole subtrees.

Split points are chosen from a bounded sample; ranges cover every row that is
indexed, so what the ranges rule out is ruled out exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .vectors import squared_distances, squares

#: Ranges are widened by this share, so that rounding never rules out what touches them.
SLACK = 1e-9


@dataclass
class Node:
    points: np.ndarray
    children: list[int | None]  # node numbers; None where the child is a leaf
    leaves: list[int | None]


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)
    leaf_count: int = 0

    @property
    def fan(self) -> int:
        return max((len(n.points) for n in self.nodes), default=1)


def spread_points(rows: np.ndarray, most: int, draw: np.random.Generator) -> np.ndarray:
    """Up to ``most`` distinct rows far from each other, out of a few drawn ones."""
    drawn = rows[draw.permutation(len(rows))[: 4 * most]]
    chosen = [0]
    nearest = squared_distances(drawn, drawn[:1])[:, 0]
    while len(chosen) < most and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared_distances(drawn, drawn[chosen[-1:]])[:, 0])
    return drawn[chosen]


def grown(sample: np.ndarray, fan: int, leaf_sample: int) -> Tree:
    """A tree whose leaves hold at most about ``leaf_sample`` rows of the sample, or copies of one row."""
    tree, draw = Tree(), np.random.default_rng(11)

    def split(rows: np.ndarray) -> tuple[int | None, int | None]:
        points = spread_points(rows, fan, draw) if len(rows) > leaf_sample else rows[:0]
        if len(points) < 2:
            tree.leaf_count += 1
            return None, tree.leaf_count - 1
        number = len(tree.nodes)
        tree.nodes.append(Node(points, [], []))
        own = squared_distances(rows, points).argmin(axis=1)
        for j in range(len(points)):
            child, leaf = split(rows[own == j])
            tree.nodes[number].children.append(child)
            tree.nodes[number].leaves.append(leaf)
        return number, None

    split(sample)
    return tree


def descend(tree: Tree, rows: np.ndarray):
    """Yields, for every node that rows pass, the node, the rows' positions, their squared distances and their child."""
    front = [(0, np.arange(len(rows)))] if tree.nodes and len(rows) else []
    while front:
        number, at = front.pop()
        node = tree.nodes[number]
        apart = squared_distances(rows[at], node.points)
        own = apart.argmin(axis=1)
        yield number, at, apart, own
        front += [(child, at[own == j]) for j, child in enumerate(node.children) if child is not None and (own == j).any()]


def leaf_of(tree: Tree, rows: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(rows), dtype=np.int64)
    for number, at, _, own in descend(tree, rows):
        numbers = np.array([-1 if n is None else n for n in tree.nodes[number].leaves])[own]
        leaf[at[numbers >= 0]] = numbers[numbers >= 0]
    return leaf


class Ranges:
    """Least and greatest squared distance from each split point to each child's rows, and of the rows' squared lengths.

    ``low[node, child, point]``; the lengths stand behind the points.  A child without rows has an empty range.
    """

    def __init__(self, tree: Tree):
        shape = (len(tree.nodes), tree.fan, tree.fan + 1)
        self.low = np.full(shape, np.iinfo(np.int64).max)
        self.high = np.full(shape, -1)

    def add(self, tree: Tree, rows: np.ndarray) -> None:
        lengths = squares(rows)
        for number, at, apart, own in descend(tree, rows):
            values = np.column_stack([apart, lengths[at]])
            for j in np.unique(own):
                part = values[own == j]
                slots = [*range(apart.shape[1]), self.low.shape[2] - 1]
                self.low[number, j, slots] = np.minimum(self.low[number, j, slots], part.min(axis=0))
                self.high[number, j, slots] = np.maximum(self.high[number, j, slots], part.max(axis=0))

    def filled(self) -> np.ndarray:
        """(node, child, slot) triples with a range."""
        return np.argwhere(self.high >= 0)


def reachable(tree: Tree, ranges: Ranges, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs that rows with an inner product in one of the query's windows can be in.

    ``low`` and ``high`` are windows of inner products, one column each; a window with low above high is none.  With
    ``s = (|q|^2 + |x|^2 - d^2) / 2`` a window of products is an annulus of distances, for rows of given lengths.
    """
    wanted = np.flatnonzero((low <= high).any(axis=1))
    if not tree.nodes:
        return wanted, np.zeros(len(wanted), dtype=np.int64)
    lengths = squares(queries).astype(np.float64)
    found_queries, found_leaves, front = [], [], [(0, wanted)] if len(wanted) else []
    while front:
        number, at = front.pop()
        node = tree.nodes[number]
        width = len(node.points)
        apart = np.sqrt(squared_distances(queries[at], node.points).astype(np.float64))
        for j in range(width):
            if ranges.high[number, j, -1] < 0:
                continue  # no rows below
            inner = np.sqrt(ranges.low[number, j, :width].astype(np.float64))
            outer = np.sqrt(ranges.high[number, j, :width].astype(np.float64))
            nearest = np.maximum(np.maximum(inner - apart, apart - outer).max(axis=1), 0.0) * (1 - SLACK)
            farthest = (apart + outer).min(axis=1) * (1 + SLACK)
            shortest, longest = float(ranges.low[number, j, -1]), float(ranges.high[number, j, -1])
            # The annulus of each window, given the lengths below this child; no product is beyond ``most``.
            own = lengths[at][:, None]
            most = (own + longest) / 2 * (1 + SLACK)
            least_product, greatest_product = np.maximum(low[at], -most), np.minimum(high[at], most)
            slack = SLACK * most + 1e-6
            r1, r2 = own + shortest - 2.0 * greatest_product - slack, own + longest - 2.0 * least_product + slack
            there = (low[at] <= high[at]) & (least_product <= most) & (greatest_product >= -most)
            met = there & (r1 <= (farthest**2)[:, None]) & (r2 >= (nearest**2)[:, None])
            left = at[met.any(axis=1)]
            if not len(left):
                continue
            if node.children[j] is not None:
                front.append((node.children[j], left))
            else:
                found_queries.append(left)
                found_leaves.append(np.full(len(left), node.leaves[j]))
    if not found_queries:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_queries), np.concatenate(found_leaves)
