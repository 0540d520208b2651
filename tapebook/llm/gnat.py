"""A geometric near-neighbour access tree over a few integer points, searched by many queries at once.

Each node takes some of its points as split points and gives every other point to the nearest of
them. For every pair of a split point and a child it stores the range of distances from the one to
the points of the other. A query that knows its distance to a split point, and the best distance so
far, leaves out each child whose range it cannot reach. Distances are compared as integers; square
roots are only used to leave children out, rounded so that a point which is as near as the best one is
never left out. So the answer equals that of comparing with all points, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Split points of a node, and the most points that are compared one by one.
DEGREE, LEAF = 4, 2


def squared(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers."""
    off = queries - points
    return np.einsum("ij,ij->i", off, off)


def _below(square: np.ndarray) -> np.ndarray:
    """A double that is not above the root of an integer (the conversion and the root err by less than two places)."""
    return np.maximum(np.nextafter(np.nextafter(np.sqrt(square.astype(np.float64)), -np.inf), -np.inf), 0)


def _above(square: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(np.sqrt(square.astype(np.float64)), np.inf), np.inf)


@dataclass
class Node:
    splits: np.ndarray
    """places of the split points"""
    children: list["Node | None"]
    least: np.ndarray
    """[split, child]: a bound below the distances from the split point to all points of the child"""
    most: np.ndarray


class Gnat:
    def __init__(self, points: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.points = np.ascontiguousarray(points, np.int64)
        self.degree, self.leaf = max(2, degree), max(1, leaf)
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, places: np.ndarray) -> Node | None:
        if not len(places):
            return None
        if len(places) <= max(self.leaf, self.degree):
            none = np.zeros((len(places), 0))
            return Node(places, [], none, none)
        # Split points far from each other: always the point whose nearest split point is farthest.
        chosen = [0]
        table = [squared(self.points[places[0]], self.points[places])]
        while len(chosen) < self.degree:
            near = np.min(table, axis=0)
            near[chosen] = -1
            chosen.append(int(near.argmax()))
            table.append(squared(self.points[places[chosen[-1]]], self.points[places]))
        away = np.array(table)
        owner = away.argmin(0)
        owner[chosen] = -1
        least, most, children = np.zeros((self.degree,) * 2), np.zeros((self.degree,) * 2), []
        for j in range(self.degree):
            own = np.flatnonzero(owner == j)
            children.append(self._build(places[own]))
            if len(own):
                least[:, j] = _below(away[:, own].min(1))
                most[:, j] = _above(away[:, own].max(1))
        return Node(places[chosen], children, least, most)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Place of the nearest point of each query (of equally near ones the first), the squared
        distance, and how many distances were computed in all."""
        place = np.full(len(queries), len(self.points), np.int64)
        best = np.full(len(queries), np.iinfo(np.int64).max, np.int64)
        work = self._search(self.root, np.arange(len(queries)), queries, place, best)
        return place, best, work

    def _search(self, node: Node | None, rows: np.ndarray, queries: np.ndarray, place: np.ndarray, best: np.ndarray) -> int:
        if node is None or not len(rows):
            return 0
        work, mine = 0, queries[rows]
        away = np.empty((len(node.splits), len(rows)), np.int64)
        for k, p in enumerate(node.splits):
            away[k] = squared(self.points[p], mine)
            better = (away[k] < best[rows]) | ((away[k] == best[rows]) & (p < place[rows]))
            best[rows[better]], place[rows[better]] = away[k][better], p
            work += len(rows)
        low, high = _below(away), _above(away)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            # The best distance shrinks from child to child.
            reach = _above(best[rows])
            gap = np.maximum(low - node.most[:, j, None], node.least[:, j, None] - high).max(0)
            work += self._search(child, rows[np.nextafter(gap, -np.inf) <= reach], queries, place, best)
        return work
