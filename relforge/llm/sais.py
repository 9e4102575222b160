"""Suffix arrays by induced sorting, and permuted common prefixes (for use inside a task).

The top level works on bytes: suffixes are classified, the leftmost-smaller (LMS) substrings are
sorted by one induction, named, and the string of names is sorted recursively; a second induction
gives the array. A bucket of the top level is handled as a whole with numpy (the entries that a bucket
induces into itself follow in rounds); on the names, whose buckets are many and small, a scan takes
runs of entries that are final.
"""

from __future__ import annotations

import numpy as np


def _suffix_types(s: np.ndarray) -> np.ndarray:
    """True for S-type suffixes. The last symbol is the smallest and occurs once; it is S-type."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int64)))
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    rising = np.append(step > 0, True)
    return np.append(rising[nearest], True)


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """The array induced by the LMS suffixes, given in the order they have within their buckets."""
    by = np.argsort(s[lms], kind="stable")
    cut = np.searchsorted(s[lms][by], np.arange(sigma + 1))
    seeds = [lms[by[cut[c] : cut[c + 1]]] for c in range(sigma)]

    def deal(entries: np.ndarray, pend: list[list[np.ndarray]]) -> None:
        symbols = s[entries]
        order = np.argsort(symbols, kind="stable")
        symbols, entries = symbols[order], entries[order]
        edges = np.flatnonzero(np.diff(symbols)) + 1
        for part, symbol in zip(np.split(entries, edges), symbols[np.concatenate([[0], edges])].tolist(), strict=True):
            pend[symbol].append(part)

    def spread(entries: np.ndarray, want_s: bool, c: int, pend: list[list[np.ndarray]]) -> np.ndarray:
        """Deal the predecessors of the wanted type to their buckets; return those of bucket c itself."""
        before = entries[entries > 0] - 1
        before = before[is_s[before] == want_s]
        own = s[before] == c
        if not own.all():
            deal(before[~own], pend)
        return before[own]

    low: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    for c in range(sigma):
        grown, i = low[c], 0
        while i < len(grown):  # entries of this bucket, those it induces into itself at the end
            own = spread(grown[i], False, c, low)
            i += 1
            if len(own):
                # they come after all that smaller buckets and earlier entries have put here
                grown.append(own)
        if len(seeds[c]):
            spread(seeds[c], False, c, low)
    low_parts = [np.concatenate(p) if p else np.empty(0, lms.dtype) for p in low]
    high: list[list[np.ndarray]] = [[] for _ in range(sigma)]  # descending
    for c in range(sigma - 1, -1, -1):
        grown, i = high[c], 0
        while i < len(grown):
            own = spread(grown[i], True, c, high)
            i += 1
            if len(own):
                grown.append(own)
        if len(low_parts[c]):
            spread(low_parts[c][::-1], True, c, high)
    out = [np.array([len(s) - 1], lms.dtype)]  # the last symbol: nothing induces it
    for c in range(sigma):
        out.append(low_parts[c])
        if high[c]:
            out.append(np.concatenate(high[c])[::-1])
    return np.concatenate(out)


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of bytes (sigma different ones); the last one must be 0 and occur nowhere else."""
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int32)
    is_s = _suffix_types(s)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    array = _induce(s, is_s, lms, sigma)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = array[is_lms[array]]  # LMS suffixes by their substrings
    names, used = _name(s, lms, ordered)
    if used < len(lms):
        ordered = lms[_sais(names, used)]
    return _induce(s, is_s, ordered, sigma)


def _name(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names, in text order, of the LMS substrings, equal ones alike; and how many names there are."""
    where = np.empty(len(s), np.int32)
    where[lms] = np.arange(len(lms), dtype=np.int32)
    rank = where[ordered]
    length = np.append(np.diff(lms) + 1, 1)[rank]
    same = np.zeros(len(ordered), bool)
    pair = np.flatnonzero(length[1:] == length[:-1]) + 1
    if len(pair):
        size = length[pair].astype(np.int64)
        starts = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(starts, size)
        equal = s[np.repeat(ordered[pair], size) + inner] == s[np.repeat(ordered[pair - 1], size) + inner]
        same[pair] = np.logical_and.reduceat(equal, starts)
    names = np.empty(len(lms), np.int64)
    names[rank] = np.cumsum(~same) - 1
    return names, int((~same).sum())


def _scan(array: np.ndarray, s: np.ndarray, take: np.ndarray, at: np.ndarray, up: bool) -> None:
    """One induction scan over an array of names, upwards (heads) or downwards (tails).

    Entries are taken in runs that end before the first place the run itself fills, so all entries of a
    run are final; what a run induces is placed at once, in the order of the run.
    """
    n, sign = len(array), 1 if up else -1
    most = 64 + 2 * int(n**0.5)
    size = most  # of the next run to look at: about twice what the last one could use
    view = array if up else array[::-1]  # scan order
    i = 0
    while i < n:
        run = view[i : i + size]
        before = run - 1
        picked = (take[before] & (run > 0)).nonzero()[0]
        if not picked.size:
            i += run.size
            continue
        entries = before[picked]
        names = s[entries]
        place = at[names]
        ordered = names.copy()
        ordered.sort()
        several = (ordered[1:] == ordered[:-1]).any()
        if several:  # the nth entry of a bucket goes n places further
            order = names.argsort(kind="stable")
            grouped = names[order]
            index = np.arange(len(grouped))
            index[1:][grouped[1:] == grouped[:-1]] = 0
            place[order] += sign * (np.arange(len(grouped)) - np.maximum.accumulate(index))
        if not up:
            place = n - 1 - place  # as a position in scan order
        stop = min(i + run.size, int(place.min()))
        k = int(picked.searchsorted(stop - i))
        view[place[:k]] = entries[:k]
        if several:
            np.add.at(at, names[:k], sign)
        else:
            at[names[:k]] += sign
        size = min(most, max(64, 2 * (stop - i)))
        i = stop


def _sais(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of a string of names; the last one is 0 and occurs nowhere else."""
    n = len(s)
    if sigma == n:
        array = np.empty(n, np.int64)
        array[s] = np.arange(n)
        return array
    is_s = _suffix_types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)

    def induce(order: np.ndarray) -> np.ndarray:
        array = np.full(n, -1, np.int64)
        names = s[order]
        by = np.argsort(names, kind="stable")
        per = np.bincount(names, minlength=sigma)
        first = np.cumsum(per) - per
        nth = np.arange(len(by)) - first[names[by]]
        array[ends[names[by]] - per[names[by]] + nth] = order[by]
        _scan(array, s, ~is_s, ends - counts, True)
        _scan(array, s, is_s, ends - 1, False)
        return array

    mark = np.zeros(n, bool)
    mark[lms] = True
    ordered = induce(lms)
    ordered = ordered[mark[ordered]]
    names, used = _name(s, lms, ordered)
    if used < len(lms):
        ordered = lms[_sais(names, used)]
    return induce(ordered)


def permuted_lcp(s: np.ndarray, array: np.ndarray, fresh: np.ndarray, most: int) -> np.ndarray:
    """For each position the common prefix with the suffix before it in the array, counted up to ``most``.

    Only irreducible positions (whose left neighbours differ) and the ``fresh`` ones are compared, eight
    symbols (bytes) at a time; any other value is one less than that of the position to its left.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[array[1:]] = array[:-1]
    compare = np.zeros(n, bool)
    compare[0] = True
    compare[fresh] = True
    inner = np.flatnonzero(phi > 0)
    inner = inner[inner > 0]
    compare[inner] |= s[inner - 1] != s[phi[inner] - 1]
    compare[phi <= 0] = True
    at = np.flatnonzero(compare & (phi >= 0))
    # eight symbols from each position on, as one number; beyond the end the two sides differ
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = s
    eight = np.ndarray((n + 8,), np.uint64, padded, 0, (1,))
    count = np.zeros(len(at), np.int64)
    live, done = np.arange(len(at)), 0
    a, b = at, phi[at]
    while len(live) and done < most:
        differ = eight[np.minimum(a + done, n)] ^ eight[np.minimum(b + done, n)]
        same = differ == 0
        end = live[~same]
        low = differ[~same]
        low = low & (~low + np.uint64(1))  # the lowest differing bit
        count[end] = done + (np.log2(low.astype(np.float64)) // 8).astype(np.int64)
        live, a, b = live[same], a[same], b[same]
        done += 8
    count[live] = done
    count = np.minimum(count, n - np.maximum(at, phi[at]))
    value = np.zeros(n, np.int64)
    value[at] = count
    last = np.maximum.accumulate(np.where(compare, np.arange(n), 0))
    return np.maximum(value[last] - (np.arange(n) - last), 0)
