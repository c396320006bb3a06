"""Suffix arrays by induced sorting, as whole-array numpy steps.

Suffixes are classified as smaller (S) or larger (L) than their right
neighbour. The leftmost S of each run (LMS) are sorted by their LMS
substrings, named, and, where names repeat, by the suffixes of the string of
names: recursively while its alphabet is small, by pairs of ranks once it is
large (a bucket then holds a few suffixes, which leaves nothing to vectorise).
From the sorted LMS suffixes one pass per direction induces all the others,
bucket by bucket.
"""

from __future__ import annotations

import numpy as np

MAX_ALPHABET = 1024     # names beyond this are sorted by rank pairs


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the last is, by definition."""
    n = len(t)
    s = np.ones(n, bool)
    # a run of equal symbols has the type of its last one
    last = np.where(t[:-1] != t[1:], np.arange(n - 1, dtype=np.int32), np.int32(n - 1))
    last = np.minimum.accumulate(last[::-1])[::-1]
    inside = last < n - 1
    s[:-1][inside] = t[last[inside]] < t[last[inside] + 1]
    return s


def _fours(t: np.ndarray) -> np.ndarray:
    """Four two-byte symbols from each position as one number, the first on top."""
    wide = np.zeros(len(t) + 3, np.uint64)
    wide[:len(t)] = t
    out = wide[:-3] << np.uint64(48)
    for k in (1, 2, 3):
        out |= wide[k:len(t) + k] << np.uint64(48 - 16 * k)
    return out


_HEAD = np.array([0, 0xFFFF << 48, 0xFFFFFFFF << 32, 0xFFFFFFFFFFFF << 16, (1 << 64) - 1], np.uint64)


def _induce(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes in (sub)order."""
    n = len(t)
    size = np.bincount(t, minlength=k)
    ends = np.cumsum(size)
    starts = ends - size
    sa = np.full(n, -1, np.int32)

    by = np.argsort(t[lms], kind="stable")
    n_lms = np.bincount(t[lms], minlength=k)
    ordered = lms[by]
    lms_ends = np.cumsum(n_lms)
    lms_starts = lms_ends - n_lms

    def spread(j, fill, step):
        """Append j to the buckets of their symbols, in order."""
        c = t[j]
        order = np.argsort(c, kind="stable")
        j, c = j[order], c[order]
        first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        count = np.diff(np.append(first, len(c)))
        nth = np.arange(len(c)) - np.repeat(first, count)
        if step > 0:
            sa[fill[c] + nth] = j
            fill[c[first]] += count
        else:
            sa[fill[c] - 1 - nth] = j
            fill[c[first]] -= count

    def larger(rows):
        j = rows[rows > 0] - 1
        return j[~s_type[j]]

    head = starts.copy()
    used = np.flatnonzero(size)
    for c in used:
        a = starts[c]
        while a < head[c]:                      # L suffixes of this bucket, also new ones
            b = head[c]
            j = larger(sa[a:b])
            a = b
            if len(j):
                spread(j, head, 1)
        j = larger(ordered[lms_starts[c]:lms_ends[c]])
        if len(j):
            spread(j, head, 1)
    l_ends = head.copy()

    def smaller(rows):
        j = rows[rows > 0] - 1
        return j[s_type[j]]

    tail = ends.copy()
    tail[t[n - 1]] -= 1
    sa[tail[t[n - 1]]] = n - 1                  # the sentinel
    for c in used[::-1]:
        b = ends[c]
        while b > tail[c]:
            a = tail[c]
            j = smaller(sa[a:b][::-1])
            b = a
            if len(j):
                spread(j, tail, -1)
        j = smaller(sa[starts[c]:l_ends[c]][::-1])
        if len(j):
            spread(j, tail, -1)
    return sa


def _names(t: np.ndarray, fours: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of each LMS substring (equal ones share it), in text order."""
    n = len(t)
    length = np.append(np.diff(lms), 0).astype(np.int32) + 1
    number = np.full(n, -1, np.int32)
    number[lms] = np.arange(len(lms))
    at = number[ordered]
    size = length[at]
    same = size[1:] == size[:-1]
    same[(ordered[1:] == n - 1) | (ordered[:-1] == n - 1)] = False
    active = np.flatnonzero(same)
    offset = 0
    while len(active):
        rest = size[active] - offset
        differ = (fours[ordered[active] + offset] ^ fours[ordered[active + 1] + offset]) \
            & _HEAD[np.minimum(rest, 4)]
        same[active[differ != 0]] = False
        offset += 4
        active = active[(differ == 0) & (rest > 4)]
    names = np.zeros(len(lms), np.int64)
    names[at] = np.concatenate(([0], np.cumsum(~same)))
    return names


def by_rank_pairs(names: np.ndarray) -> np.ndarray:
    """Suffix order by doubling; only suffixes not yet alone are sorted again."""
    n = len(names)
    rank = names.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    s = rank[order]
    first = np.concatenate(([True], s[1:] != s[:-1]))
    lead = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = lead
    step = 1
    while True:
        alone = first & np.append(first[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            return order
        rows = order[open_]
        ahead = np.where(rows + step < n, rank[np.minimum(rows + step, n - 1)] + 1, 0)
        group = rank[rows]
        pair = group * np.int64(n + 1) + ahead
        by = np.argsort(pair)
        pair = pair[by]
        order[open_] = rows[by]
        first[open_] = np.concatenate(([True], pair[1:] != pair[:-1]))
        lead = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        rank[order[open_]] = lead[open_]
        step *= 2


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Order of the suffixes of t: two-byte symbols below k, the last the only 0."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    s_type = _types(t)
    is_lms = np.concatenate(([False], s_type[1:] & ~s_type[:-1]))
    lms = np.flatnonzero(is_lms).astype(np.int32)
    sa = _induce(t, s_type, lms, k)
    ordered = sa[is_lms[sa]]
    names = _names(t, _fours(t), lms, ordered)
    top = int(names.max()) + 1
    if top == len(lms):
        return _induce(t, s_type, ordered, k)
    if top <= MAX_ALPHABET:
        order = suffix_array(names.astype(np.uint16), top)
    else:
        order = by_rank_pairs(names)
    return _induce(t, s_type, lms[order], k)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Per text position: common prefix with the suffix before it in the order.

    Where the symbols before a suffix and its predecessor agree, the value is
    one less than that of the position before; only the other positions are
    compared symbol by symbol.
    """
    n = len(t)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    at = np.arange(n)
    known = (before > 0) & (at > 0)
    reducible = np.zeros(n, bool)
    reducible[known] = t[at[known] - 1] == t[before[known] - 1]
    # a chain goes on only where the predecessor moves along too
    chained = np.zeros(n, bool)
    chained[1:] = reducible[1:] & (before[1:] == before[:-1] + 1)
    lead = np.flatnonzero(~chained)
    plcp = np.zeros(n, np.int64)
    fours = _fours(t)
    active = lead[before[lead] >= 0]
    while len(active):
        x, y = active + plcp[active], before[active] + plcp[active]
        differ = fours[x] ^ fours[y]
        # equal symbols at the top; beyond the end there are zeros, which only the last symbol is
        same = (differ < 1 << 48).astype(np.int64) + (differ < 1 << 32) + (differ < 1 << 16)
        whole = differ == 0
        plcp[active] += same + whole
        active = active[whole]
    head = np.maximum.accumulate(np.where(chained, 0, at))
    return np.maximum(plcp[head] - (at - head), 0)
