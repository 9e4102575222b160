"""A BM25 inverted index of short texts with block-max WAND retrieval, for use inside a task.

Weights come from statistics of the whole collection, which the caller counts, so that a score does not depend on
which texts share an index. Each text has a threshold of its own, as a share of its full score; impacts are divided by it,
and a search is for what reaches 1.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np

K1, B = 1.2, 0.75
BLOCK, FINE = 16, 2
#: Up to this size the maxima of blocks of 2 units are also kept as a table, for a test of all blocks at once.
TABLE_BYTES = 16_000_000


class Weights:
    """BM25 weights from a collection's number of units, their mean length, and the units that hold each word."""

    def __init__(self, units: int, mean: float, holders: dict[bytes, int]):
        self.n, self.mean, self.holders = units, max(mean, 1e-9), holders

    @classmethod
    def of(cls, units: list[list[bytes]]) -> Weights:
        return cls(len(units), sum(map(len, units)) / max(1, len(units)), Counter(w for unit in units for w in set(unit)))

    def impacts(self, unit: list[bytes]) -> dict[bytes, float]:
        """The share of each word in the unit's full score, which is 1."""
        norm, n, holders = K1 * (1 - B + B * len(unit) / self.mean), self.n, self.holders
        impact = {w: math.log(1 + (n - holders[w] + 0.5) / (holders[w] + 0.5)) * f * (K1 + 1) / (f + norm) for w, f in Counter(unit).items()}
        total = sum(impact.values())
        return {w: x / total for w, x in impact.items()}


class BlockMaxIndex:
    """Units (lists of words) with their impacts, each divided by the unit's threshold.

    Postings are sorted by unit and cut into blocks of 16, each with its largest impact.
    """

    def __init__(self, impacts: list[dict[bytes, float]], thresholds: list[float] | None = None):
        n = len(impacts)
        self.threshold = thresholds or [1.0] * n
        postings: dict[bytes, list[tuple[int, float]]] = defaultdict(list)
        for u, impact in enumerate(impacts):
            for w, x in impact.items():
                postings[w].append((u, x / self.threshold[u]))
        self.term_of = {w: t for t, w in enumerate(postings)}
        self.units = [[u for u, _ in p] for p in postings.values()]
        self.impacts = [[x for _, x in p] for p in postings.values()]
        self.block_max = [[max(x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.impacts]
        self.bound = np.array([max(x) for x in self.impacts] or [0.0])
        self.table = None
        if 4 * len(postings) * (-(-n // FINE)) <= TABLE_BYTES:
            self.table = np.zeros((len(postings), -(-n // FINE)), np.float32)
            for t, p in enumerate(postings.values()):
                for u, x in p:
                    self.table[t, u // FINE] = max(self.table[t, u // FINE], x)

    def search(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """All (unit, score) with score >= least for a query of distinct terms."""
        if self.table is not None and not (self.table[terms].sum(axis=0) >= least - 1e-5).any():
            return []
        hits = []
        bound, units, impacts, block_max = self.bound, self.units, self.impacts, self.block_max
        cursors = [[units[t][0], t, 0] for t in terms]  # current unit, term, position
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(cursors):
                total += bound[t]
                if total >= least:
                    pivot = i
                    break
            if pivot < 0:
                break
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            # block bounds of the lists up to the pivot, each at the block that may hold the pivot unit
            cap, upto = 0.0, None
            for c in cursors[: pivot + 1]:
                t, own = c[1], units[c[1]]
                block = c[2] // BLOCK
                while (block + 1) * BLOCK < len(own) and own[(block + 1) * BLOCK - 1] < at:
                    block += 1
                end = own[min((block + 1) * BLOCK, len(own)) - 1]
                cap += block_max[t][block] if end >= at else 0.0
                upto = end if upto is None or (at <= end < upto) or upto < at else upto
            if cap >= least:
                if cursors[0][0] == at:
                    score = sum(impacts[c[1]][c[2]] for c in cursors[: pivot + 1])
                    if score >= least:
                        hits.append((at, score))
                    target = at + 1
                else:
                    target = at
            else:  # no unit before the nearest block end can reach the threshold with these lists
                target = max(at, upto) + 1
                if pivot + 1 < len(cursors):
                    target = min(target, max(at + 1, cursors[pivot + 1][0]))
            for c in cursors[: pivot + 1]:
                own, i = units[c[1]], c[2]
                while i < len(own) and own[i] < target:
                    i += 1
                c[2] = i
                c[0] = own[i] if i < len(own) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return hits
