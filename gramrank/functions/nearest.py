"""Nearest of many centres in the plane, by a tree of boxes.

Centres are split in halves, by their wider side, until few are left in a box. A point
first goes down to one box, which gives it a distance to beat, and then looks only into
boxes that are no farther away than its best centre so far. All points of a batch go
through the tree together.

Results equal those of comparing each point with every centre, ties included: the first
centre listed wins. The distance to a box is computed with the same rounding steps as
that to a centre, so it never exceeds that of a centre inside it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Centres that a box is not split below.
LEAF = 8


class CentreTree:
    """``nearest`` finds the place of the nearest centre in the lists given. Centres whose
    coordinates are not finite are never nearest, unless there are no others.

    ``compared`` counts the distances to centres that were computed."""

    def __init__(self, xs: Sequence[float], ys: Sequence[float]):
        if not len(xs):
            raise ValueError("there are no centres")
        self.x = np.asarray(xs, dtype=np.float64)
        self.y = np.asarray(ys, dtype=np.float64)
        self.compared = 0
        self._boxes: list[tuple[float, float, float, float]] = []
        #: Centres of a leaf, or the axis, the border and the two parts of a node.
        self._nodes: list[np.ndarray | tuple[int, float, int, int]] = []
        # of centres at one place the first is never beaten by another
        _, first = np.unique(np.stack([self.x, self.y]), axis=1, return_index=True)
        finite = first[np.isfinite(self.x[first]) & np.isfinite(self.y[first])]
        self._root = self._split(np.sort(finite) if len(finite) else np.zeros(1, dtype=np.int64))

    def _split(self, places: np.ndarray) -> int:
        x, y = self.x[places], self.y[places]
        node = len(self._nodes)
        self._boxes.append((x.min(), x.max(), y.min(), y.max()))
        self._nodes.append(places)
        if len(places) > LEAF:
            axis = int(np.ptp(y) > np.ptp(x))
            values = (x, y)[axis]
            order = np.argsort(values, kind="stable")
            half = len(places) // 2
            border = float(values[order[half]])
            parts = self._split(places[order[:half]]), self._split(places[order[half:]])
            self._nodes[node] = (axis, border, *parts)
        return node

    def _to_box(self, node: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        west, east, south, north = self._boxes[node]
        dx = np.maximum(np.maximum(west - x, x - east), 0.0)
        dy = np.maximum(np.maximum(south - y, y - north), 0.0)
        return np.sqrt(dx * dx + dy * dy)

    def nearest(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the nearest centre, and the distance to it, of each point."""
        place = np.zeros(len(x), dtype=np.int64)
        best = np.full(len(x), np.inf)
        home = np.full(len(x), -1)
        self._go_home(self._root, np.arange(len(x)), x, y, place, best, home)
        self._look(self._root, np.arange(len(x)), x, y, place, best, home)
        return place, best

    def _compare(self, centres, points, x, y, place, best) -> None:
        """Sets ``place`` and ``best`` of the points where a centre is nearer, or as near
        and listed before."""
        self.compared += len(centres) * len(points)
        dx = x[points, None] - self.x[centres]
        dy = y[points, None] - self.y[centres]
        far = np.sqrt(dx * dx + dy * dy)
        least = far.min(axis=1)
        first = np.where(far == least[:, None], centres, len(self.x)).min(axis=1)
        old = best[points]
        better = (least < old) | ((least == old) & (first < place[points]))
        place[points[better]] = first[better]
        best[points[better]] = least[better]

    def _go_home(self, node, points, x, y, place, best, home) -> None:
        if not len(points):
            return
        parts = self._nodes[node]
        if isinstance(parts, np.ndarray):
            home[points] = node
            self._compare(parts, points, x, y, place, best)
            return
        axis, border, low, high = parts
        below = (x, y)[axis][points] < border
        self._go_home(low, points[below], x, y, place, best, home)
        self._go_home(high, points[~below], x, y, place, best, home)

    def _look(self, node, points, x, y, place, best, home) -> None:
        points = points[self._to_box(node, x[points], y[points]) <= best[points]]
        if not len(points):
            return
        parts = self._nodes[node]
        if isinstance(parts, np.ndarray):
            self._compare(parts, points[home[points] != node], x, y, place, best)
            return
        for part in parts[2:]:
            self._look(part, points, x, y, place, best, home)
