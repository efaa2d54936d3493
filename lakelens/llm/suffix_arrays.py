"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard's text.

A suffix is smaller (S) or larger (L) than the one after it; an S suffix after an L suffix is leftmost-smaller (LMS).
The substrings between neighbouring LMS places are sorted by one round of inducing and named; if names repeat, the string of
names is sorted in the same way, recursively. The order of the LMS suffixes then induces the whole array in two linear
scans: L suffixes from the bucket heads, S suffixes from the tails.

Scans go over a bucket at a time: all suffixes of a bucket that are known are followed by their predecessors in one vector step, in
scan order; those that fall into the same bucket make the next step. Strings of names have too many buckets for that
and are scanned one by one.

Common prefixes are computed in text order. Where a suffix and its predecessor in the array are preceded by the same symbol, the common
prefix is one less than that of the place before; only the others are compared.
"""

from __future__ import annotations

import numpy as np

#: Shorter strings, and those with fewer symbols to a bucket, are scanned one by one.
FEW, BUCKET = 4_096, 64
#: A step with fewer suffixes is done one by one.
STEP = 12


def _smaller(s: np.ndarray) -> np.ndarray:
    """True for S suffixes; the last symbol is the least and stands alone."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    at = np.searchsorted(differs, np.arange(n - 1))
    next_differs = differs[at] if n > 1 else at
    small = np.ones(n, bool)
    small[:-1] = s[next_differs] < s[next_differs + 1]
    return small


def _scan(s: np.ndarray, small: np.ndarray, sorted_lms: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The array that the LMS suffixes in this order induce, one suffix at a time."""
    # The symbol before every place, where that suffix is of the kind; -1 elsewhere and, at the end, for free places.
    before = np.full((2, len(s) + 1), -1, np.int64)
    before[0, 1:-1] = np.where(small[:-1], -1, s[:-1])
    before[1, 1:-1] = np.where(small[:-1], s[:-1], -1)
    larger, smaller = before.tolist()
    sa, at = [-1] * len(s), stops.tolist()
    for i, c in zip(sorted_lms[::-1].tolist(), s[sorted_lms][::-1].tolist()):
        at[c] -= 1
        sa[at[c]] = i
    at = starts.tolist()
    for x in sa:
        c = larger[x]
        if c >= 0:
            place = at[c]
            sa[place] = x - 1
            at[c] = place + 1
    at = stops.tolist()
    for place in range(len(sa) - 1, -1, -1):
        x = sa[place]
        c = smaller[x]
        if c >= 0:
            at[c] -= 1
            sa[at[c]] = x - 1
    return np.array(sa, np.int64)


class _Buckets:
    """The same, a bucket at a time."""

    def __init__(self, s: np.ndarray, small: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        self.s, self.small, self.starts, self.stops = s, small, starts, stops
        self.sa = np.full(len(s), -1, np.int32)

    def _follow(self, items: np.ndarray, kind: bool, at: np.ndarray, step: int) -> None:
        """Puts the predecessors of this kind, in the order of `items`, at the next free places of their buckets."""
        if len(items) < STEP:
            for x in items.tolist():
                if x > 0 and bool(self.small[x - 1]) == kind:
                    c = self.s[x - 1]
                    if step < 0:
                        at[c] -= 1
                    self.sa[at[c]] = x - 1
                    if step > 0:
                        at[c] += 1
            return
        before = items[items > 0] - 1
        before = before[self.small[before] == kind]
        if not len(before):
            return
        symbols = self.s[before]
        order = np.argsort(symbols, kind="stable")
        counts = np.bincount(symbols, minlength=len(at))
        ordered = symbols[order]
        rank = np.arange(len(order)) - (np.cumsum(counts) - counts)[ordered]
        places = at[ordered] + rank if step > 0 else at[ordered] - 1 - rank
        self.sa[places] = before[order]
        at += step * counts

    def induced(self, sorted_lms: np.ndarray) -> np.ndarray:
        sa, starts, stops = self.sa, self.starts, self.stops
        sa.fill(-1)
        symbols = self.s[sorted_lms]
        order = np.argsort(symbols, kind="stable")
        lms = np.bincount(symbols, minlength=len(starts))
        rank = np.arange(len(order)) - (np.cumsum(lms) - lms)[symbols[order]]
        sa[(stops - lms)[symbols[order]] + rank] = sorted_lms[order]
        buckets = np.flatnonzero(stops > starts).tolist()
        at = starts.copy()
        for c in buckets:
            done = int(starts[c])
            while done < at[c]:
                upto = int(at[c])
                self._follow(sa[done:upto].copy(), False, at, 1)
                done = upto
            self._follow(sa[stops[c] - lms[c] : stops[c]].copy(), False, at, 1)
        larger = at
        at = stops.copy()
        for c in reversed(buckets):
            if c == 0:
                break
            done = int(stops[c])
            while done > at[c]:
                upto = int(at[c])
                self._follow(sa[upto:done][::-1].copy(), True, at, -1)
                done = upto
            self._follow(sa[starts[c] : larger[c]][::-1].copy(), True, at, -1)
        return sa


def _names(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """For the LMS places in the order of their substrings, the number of the substring; equal ones share it."""
    length = np.zeros(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    a, b = ordered[:-1], ordered[1:]
    new = length[a] != length[b]
    open_, offset = np.flatnonzero(~new), 0
    while len(open_):
        left, right = a[open_], b[open_]
        unlike = s[left + offset] != s[right + offset]
        new[open_[unlike]] = True
        offset += 1
        open_ = open_[~unlike & (length[left] > offset)]
    return np.concatenate([[0], np.cumsum(new)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order. The last symbol must be 0, which stands nowhere else; symbols are small numbers."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = _smaller(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    counts = np.bincount(s)
    stops = np.cumsum(counts)
    starts = stops - counts
    if n < FEW or len(counts) * BUCKET > n:
        induced = lambda order: _scan(s, small, order, starts, stops)
    else:
        induced = _Buckets(s, small, starts, stops).induced
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    first = induced(lms)
    ordered = first[is_lms[first]].astype(np.int64)
    names = _names(s, lms, ordered)
    if names[-1] + 1 < len(lms):
        number = np.zeros(n, np.int64)
        number[ordered] = names
        ordered = lms[suffix_array(number[lms])]
    return induced(ordered)


def permuted_prefixes(s: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place its predecessor in the array (-1 for the first) and the length of their common prefix."""
    n = len(s)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    wide = np.zeros(n, np.uint64)
    padded = np.concatenate([s, np.zeros(3, s.dtype)]).astype(np.uint64)
    for i in range(4):
        wide |= padded[i : i + n] << np.uint64(16 * i)
    fresh = np.ones(n, bool)
    inner = np.flatnonzero(before[1:] > 0) + 1
    fresh[inner] = s[inner - 1] != s[before[inner] - 1]
    length = np.zeros(n, np.int64)
    compared = np.flatnonzero(fresh & (before >= 0))
    open_, offset = compared, 0
    while len(open_):
        same = wide[open_ + offset] == wide[before[open_] + offset]
        length[open_[~same]] = offset
        open_ = open_[same]
        offset += 4
    for _ in range(3):
        more = s[compared + length[compared]] == s[before[compared] + length[compared]]
        compared = compared[more]
        length[compared] += 1
    # A place after a compared one has one less for every step.
    since = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return before, np.maximum(length[since] - (np.arange(n) - since), 0)


def repeated_places(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For every text the places at which `width` bytes begin that begin at another place of any of the texts too."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    # 0 ends the shard, 1 ends a text, bytes follow.
    s = np.ones(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    s[-1] = 0
    inside = np.ones(len(s), bool)
    inside[ends - 1] = False
    inside[-1] = False
    s[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 2
    before, length = permuted_prefixes(s, suffix_array(s))
    again = np.zeros(len(s), bool)
    left = np.repeat(ends - 1, sizes + 1) - np.arange(len(s) - 1)
    long_ = np.flatnonzero((length[:-1] >= width) & (left >= width))
    again[long_] = True
    again[before[long_]] = True
    return [np.flatnonzero(again[end - size - 1 : end - 1]) for end, size in zip(ends.tolist(), sizes.tolist())]
