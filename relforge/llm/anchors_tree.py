"""Anchors-hierarchy metric trees over the parts of vectors, and their walk for one k-means round.

A forest has one tree for each part position over the same vectors. A tree is built middle-out: about
sqrt(n) anchors share the points of a ball, a new anchor being the point farthest from its own one and
taking over only points that the triangle inequality leaves open; the anchors' balls are then merged two
by two, the most compact pair first, up to the ball itself, and each of them is divided in the same way
until it is small. Every ball caches its number of points, their sum, its centroid and its radius.

The walk takes the balls level by level. A ball inherits the entries that could be nearest within its
parent. Entry j goes once entry i, the nearest to the centroid c, is nearer for every point of the ball:
|c-j|^2 - |c-i|^2 > 2 r |i-j|, with room for rounding, so that an entry that could tie never goes; only
one of equal entries, the lowest, can win a tie and stays. A ball with one entry left is owned by it as a
whole, and its cached sum and count are added; in a small ball the entries left are compared exactly, in
integers.
"""

from __future__ import annotations

import io

import numpy as np

#: Balls of at most so many points are not divided.
LEAF = 24
_FAR = np.iinfo(np.int64).max


def _apart(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    gap = points - one
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _anchors(points: np.ndarray) -> tuple[np.ndarray, int]:
    """The owner (0, 1, ...) of each point, for about sqrt(n) anchors; fewer where points are equal."""
    n = len(points)
    owner, apart, chosen = np.zeros(n, np.int64), _apart(points, points[0]), [0]
    for k in range(1, max(2, int(np.ceil(np.sqrt(n))))):
        new = int(np.argmax(apart))
        if apart[new] <= 0:
            break
        between = _apart(points[chosen], points[new])
        open_ = np.flatnonzero(apart > between[owner] / 2)  # others cannot be nearer to the new anchor
        reach = _apart(points[open_], points[new])
        won = reach < apart[open_]
        owner[open_[won]], apart[open_[won]] = k, reach[won]
        chosen.append(new)
    return owner, len(chosen)


def _merged(centres: np.ndarray, radii: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Merges of balls two by two, the smallest common ball first; merge k makes ball len(centres) + k."""
    k = len(centres)
    c, r, m, name, live = centres.copy(), radii.copy(), counts.astype(float), list(range(k)), np.ones(k, bool)

    def common(i: int) -> np.ndarray:
        apart = _apart(c, c[i])
        share = m / (m + m[i])  # how far the common centroid is from ball i, towards the other
        radius = np.maximum(r[i] + apart * share, r + apart * (1 - share))
        radius[~live] = np.inf
        radius[i] = np.inf
        return radius

    cost, out = np.array([common(i) for i in range(k)]), []
    for step in range(k - 1):
        i, j = divmod(int(np.argmin(cost)), k)
        out.append((name[i], name[j]))
        radius = cost[i, j]
        c[i], r[i] = (m[i] * c[i] + m[j] * c[j]) / (m[i] + m[j]), radius
        m[i], name[i], live[j] = m[i] + m[j], k + step, False
        cost[j, :] = cost[:, j] = np.inf
        cost[i, :] = cost[:, i] = common(i)
    return out


class _Tree:
    """Balls as slices of one order of the points, parents before children."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.low, self.high, self.level, self.kids = [0], [len(points)], [0], [(-1, -1)]
        todo = [0]
        while todo:
            todo.extend(self._divide(todo.pop(), points))

    def _add(self, low: int, high: int, level: int) -> int:
        self.low.append(low), self.high.append(high), self.level.append(level), self.kids.append((-1, -1))
        return len(self.low) - 1

    def _divide(self, ball: int, points: np.ndarray) -> list[int]:
        """Divide a ball into its anchors' balls and the merges between; the former are divided next."""
        low, high = self.low[ball], self.high[ball]
        if high - low <= LEAF:
            return []
        held = self.order[low:high]
        own = points[held]
        owner, k = _anchors(own)
        if k == 1:
            return []  # all points are equal
        counts = np.bincount(owner, minlength=k)
        centres = np.stack([np.bincount(owner, own[:, d], k) for d in range(own.shape[1])], 1) / counts[:, None]
        gap = own - centres[owner]
        radii = np.zeros(k)
        np.maximum.at(radii, owner, np.sqrt(np.einsum("ij,ij->i", gap, gap)))
        merges = _merged(centres, radii, counts)
        # the points in the order of the merged tree's leaves, so that each ball is a slice
        at, ends, todo, stack = low, [], [], [(2 * k - 2, ball)]
        groups = np.split(np.argsort(owner, kind="stable"), np.cumsum(counts)[:-1])
        size = [*counts.tolist()]
        for i, j in merges:
            size.append(size[i] + size[j])
        self.low[ball], self.high[ball] = low, high
        while stack:
            group, node = stack.pop()
            if group < k:
                ends.append(held[groups[group]])
                todo.append(node)
                continue
            i, j = merges[group - k]
            start, level = self.low[node], self.level[node] + 1
            left = self._add(start, start + size[i], level)
            right = self._add(start + size[i], self.high[node], level)
            self.kids[node] = (left, right)
            stack += [(j, right), (i, left)]  # the left one first, as its points come first
        self.order[at:high] = np.concatenate(ends)
        return todo


class Forest:
    """One tree for each part position over the same vectors, as flat arrays."""

    NAMES = ("order", "low", "high", "level", "kids", "part", "total", "radius")

    def __init__(self, **arrays: np.ndarray):
        self.order, self.low, self.high, self.level, self.kids, self.part, self.total, self.radius = (arrays[name] for name in self.NAMES)
        self.centre = self.total / (self.high - self.low)[:, None]

    @classmethod
    def over(cls, parts: np.ndarray) -> Forest:
        """``parts``: integers by part position, vector and place within the part."""
        found: dict[str, list] = {name: [] for name in cls.NAMES}
        before = 0
        for p, points in enumerate(parts):
            tree = _Tree(points.astype(float))
            low, high, kids = np.array(tree.low), np.array(tree.high), np.array(tree.kids)
            sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[tree.order], 0)])
            total = sums[high] - sums[low]
            centre = total / (high - low)[:, None]
            radius = np.zeros(len(low))
            for level in range(max(tree.level) + 1):  # the balls of one level are slices that do not overlap
                here = np.flatnonzero(np.array(tree.level) == level)
                here = here[np.argsort(low[here])]
                which = np.repeat(here, (high - low)[here])
                spots = np.concatenate([np.arange(low[b], high[b]) for b in here])
                gap = points[tree.order[spots]] - centre[which]
                starts = np.concatenate([[0], np.cumsum((high - low)[here])[:-1]])
                radius[here] = np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", gap, gap), starts))
            radius = radius * (1 + 1e-9) + 1e-9
            for name, value in (("order", tree.order), ("low", low), ("high", high), ("level", np.array(tree.level)), ("kids", np.where(kids >= 0, kids + before, -1)),
                                ("part", np.full(len(low), p)), ("total", total), ("radius", radius)):
                found[name].append(value)
            before += len(low)
        order = found.pop("order")
        return cls(order=np.array(order), **{name: np.concatenate(values) for name, values in found.items()})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: value.astype(np.int32) if value.dtype == np.int64 and name != "total" else value
                         for name in self.NAMES for value in [getattr(self, name)]})
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> Forest:
        with np.load(io.BytesIO(raw), allow_pickle=False) as found:
            return cls(**found)

    def walk(self, parts: np.ndarray, books: np.ndarray) -> Walk:
        """One round over the vectors; ``books``: integers by part position, entry and place."""
        out = Walk(parts.shape[0], parts.shape[1], books.shape[1], books.shape[2])
        real = books.astype(float)
        equal = (books[:, :, None, :] == books[:, None, :, :]).all(-1)
        lowest = ~np.tril(equal, -1).any(-1)  # not equal to an entry before it
        balls = np.flatnonzero(self.level == 0)
        left = lowest[self.part[balls]]
        while len(balls):
            entries = real[self.part[balls]]
            gap = entries - self.centre[balls][:, None, :]
            square = np.einsum("bed,bed->be", gap, gap)
            square[~left] = np.inf
            near = np.argmin(square, 1)
            at = np.arange(len(balls))
            between = entries - entries[at, near][:, None, :]
            between = np.sqrt(np.einsum("bed,bed->be", between, between))
            least = square[at, near][:, None]
            square[~left] = 0.0
            out_of_reach = square - least > (2 * self.radius[balls][:, None] * between + 1e-9 * (square + least)) * (1 + 1e-9) + 1e-6
            left = left & ~out_of_reach
            whole = left.sum(1) == 1
            small = ~whole & (self.kids[balls, 0] < 0)
            self._own(balls[whole], near[whole], out)
            self._compare(balls[small], left[small], parts, books, out)
            go = ~whole & ~small
            out.looked += len(balls)
            left = np.repeat(left[go], 2, 0)
            balls = self.kids[balls[go]].reshape(-1)
        return out

    def _spots(self, balls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slots in the order of the points of each ball, and the ball's place in the list for each."""
        n = self.high[balls] - self.low[balls]
        which = np.repeat(np.arange(len(balls)), n)
        start = np.concatenate([[0], np.cumsum(n)[:-1]])
        return self.low[balls][which] + np.arange(n.sum()) - start[which], which

    def _own(self, balls: np.ndarray, entry: np.ndarray, out: Walk) -> None:
        if len(balls):
            part = self.part[balls]
            np.add.at(out.sums, (part, entry), self.total[balls])
            np.add.at(out.counts, (part, entry), self.high[balls] - self.low[balls])
            spots, which = self._spots(balls)
            out.entry[part[which], self.order[part[which], spots]] = entry[which]
            out.owned += len(spots)

    def _compare(self, balls: np.ndarray, left: np.ndarray, parts: np.ndarray, books: np.ndarray, out: Walk) -> None:
        if len(balls):
            spots, which = self._spots(balls)
            part = self.part[balls][which]
            row = self.order[part, spots]
            points, best, entry = parts[part, row].astype(np.int64), np.full(len(row), _FAR), np.zeros(len(row), np.int64)
            for e in range(books.shape[1]):  # ascending, so that ties stay with the lower index
                held = np.flatnonzero(left[which, e])
                gap = points[held] - books[part[held], e]
                square = np.einsum("ij,ij->i", gap, gap)
                less = square < best[held]
                best[held[less]], entry[held[less]] = square[less], e
            out.entry[part, row] = entry
            np.add.at(out.sums, (part, entry), points)
            np.add.at(out.counts, (part, entry), 1)


class Walk:
    """What a walk gathers: sums and counts by part and entry, and the entry of each part of each vector."""

    def __init__(self, parts: int, vectors: int, entries: int, width: int):
        self.sums, self.counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        self.entry = np.zeros((parts, vectors), np.int64)
        self.looked = self.owned = 0
