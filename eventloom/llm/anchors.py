"""Anchors-hierarchy metric trees: balls built from the middle out, with cached sums and counts.

A tree over m points starts in the middle: about sqrt(m) anchors, each new one the point
farthest from the anchor with the largest radius, taking over the points that are nearer
to it (those nearer to their old anchor than half the anchors' distance can't be). Upwards, the two
balls whose union is smallest are merged until one is left; downwards, every anchor's
points are made into a tree the same way until a ball has ``LEAF`` points at most.

Points are whole numbers. Sums, counts and compared distances are exact: float64 while every
intermediate result is below 2^53, Python integers beyond. Radii and pivots are float64,
and what they rule out is ruled out with a margin far above their rounding.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

LEAF = 32
#: Relative margin of tests on float distances; rounding is about 1e-15.
MARGIN = 1e-9


class Tree(NamedTuple):
    """``points`` in the order of the leaves (``order``: their places before). Node 0 is the root; a node
    covers ``points[start : end]`` and its children are ``first`` to ``last`` - 1 (none: a leaf)."""

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    pivot: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def exact_type(largest: int, width: int) -> type:
    """The type in which squared distances of ``width`` components up to ``largest`` are exact."""
    return np.float64 if 8 * width * largest * largest < 1 << 53 else object


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every entry, exact in the type of ``points``."""
    cross = points @ entries.T
    return (points * points).sum(axis=1)[:, None] + (entries * entries).sum(axis=1)[None, :] - 2 * cross


def _distances(points: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - pivot) ** 2).sum(axis=1))


def _anchors(points: np.ndarray, wanted: int) -> list[np.ndarray]:
    """The places of the points of each anchor."""
    owned = [np.arange(len(points))]
    far = [_distances(points, points[0])]
    at = [points[0]]
    while len(owned) < wanted:
        widest = max(range(len(owned)), key=lambda k: far[k].max())
        if far[widest].max() == 0:
            break
        new = points[owned[widest][far[widest].argmax()]]
        took, took_far = [], []
        for k in range(len(owned)):
            between = np.sqrt(((new - at[k]) ** 2).sum())
            near = np.flatnonzero(far[k] > between / 2)
            d = _distances(points[owned[k][near]], new)
            steal = d < far[k][near]
            if steal.any():
                took.append(owned[k][near[steal]])
                took_far.append(d[steal])
                stay = np.ones(len(owned[k]), bool)
                stay[near[steal]] = False
                owned[k], far[k] = owned[k][stay], far[k][stay]
        owned.append(np.concatenate(took))
        far.append(np.concatenate(took_far))
        at.append(new)
    return owned


class _Ball:
    """A node while the tree is built: its points' places in leaf order, and its children."""

    __slots__ = ("places", "children", "pivot", "radius")

    def __init__(self, points: np.ndarray, places: np.ndarray, children: list[_Ball]) -> None:
        self.places, self.children = places, children
        self.pivot = points[places].mean(axis=0)
        self.radius = float(_distances(points[places], self.pivot).max())


def _grow(points: np.ndarray, places: np.ndarray) -> _Ball:
    if len(places) <= LEAF:
        return _Ball(points, places, [])
    groups = _anchors(points[places], max(2, int(len(places) ** 0.5)))
    if len(groups) == 1:  # equal points
        return _Ball(points, places, [])
    balls = [_grow(points, places[g]) for g in groups]
    # Upwards: the radius of a union is bounded by the distance of the pivots and both radii.
    pivots, radii = np.array([b.pivot for b in balls]), np.array([b.radius for b in balls])
    apart = np.sqrt(((pivots[:, None] - pivots[None]) ** 2).sum(axis=2))
    cost = (apart + radii[:, None] + radii[None]) / 2
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(balls) - 1):
        a, b = sorted(divmod(int(cost.argmin()), len(balls)))
        joined = _Ball(points, np.concatenate([balls[a].places, balls[b].places]), [balls[a], balls[b]])
        balls[a], balls[b] = joined, None
        pivots[a], radii[a] = joined.pivot, joined.radius
        cost[b], cost[:, b] = np.inf, np.inf
        open_ = np.isfinite(cost[a])
        row = np.where(open_, (np.sqrt(((pivots - joined.pivot) ** 2).sum(axis=1)) + radii + joined.radius) / 2, np.inf)
        cost[a], cost[:, a] = row, row
    return balls[0]


def build(points: np.ndarray) -> Tree:
    """The tree of at least one point, whole numbers in an exact type."""
    rough = points.astype(np.float64)
    root = _grow(rough, np.arange(len(points)))
    nodes, spans = [root], [(0, len(points))]
    first, last = [], []
    k = 0
    while k < len(nodes):
        first.append(len(nodes))
        at = spans[k][0]
        for child in nodes[k].children:
            nodes.append(child)
            spans.append((at, at + len(child.places)))
            at += len(child.places)
        last.append(len(nodes))
        k += 1
    start, end = np.array(spans, np.int64).T
    ordered = points[root.places]
    sums = np.array([ordered[a:b].sum(axis=0) for a, b in spans])
    return Tree(ordered, root.places, start, end, np.array(first), np.array(last), np.array([n.pivot for n in nodes]), np.array([n.radius for n in nodes]), sums)


def owners(tree: Tree, entries: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(node, entry of each of its points, or the one entry that owns it) for balls that cover the tree.

    Each node takes the candidate entries of its parent and keeps those that can be nearest
    to some point of the ball: j is out if even at the ball's edge some i is nearer,
    |p - j|^2 - |p - i|^2 > 2 r |i - j|. A ball with one candidate is wholly owned. The nearest
    entry of a leaf's points is by exact distance, the lowest number among equals.
    """
    rough = entries.astype(np.float64)
    between = np.sqrt(np.maximum(0.0, squared(rough, rough)))
    out = []
    todo = [(0, np.arange(len(entries)))]
    while todo:
        node, candidates = todo.pop()
        if len(candidates) > 1:
            away = ((rough[candidates] - tree.pivot[node]) ** 2).sum(axis=1)
            best = int(away.argmin())
            lead = away - away[best]
            reach = 2 * tree.radius[node] * between[candidates[best], candidates]
            candidates = candidates[lead <= reach + MARGIN * (1 + away + reach)]
        if len(candidates) == 1:
            out.append((node, candidates))
        elif tree.first[node] < tree.last[node]:
            todo.extend((child, candidates) for child in range(tree.first[node], tree.last[node]))
        else:
            d = squared(tree.points[tree.start[node] : tree.end[node]], entries[candidates])
            out.append((node, candidates[d.argmin(axis=1)]))
    return out
