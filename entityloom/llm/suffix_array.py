"""Suffix arrays and common prefixes of many short segments at once, in numpy."""

from __future__ import annotations

import numpy as np


class Segments:
    """Byte segments in one array, each followed by an end mark that equals nothing, not even another."""

    def __init__(self, segments: list[bytes]):
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        self.raw = np.frombuffer(b"\x00".join(segments) + b"\x00", np.uint8)
        n = len(self.raw)
        self.segment = np.repeat(np.arange(len(segments)), sizes + 1)
        self.end = np.repeat(self.starts + sizes, sizes + 1)  # the end mark of each place
        self.left = self.end - np.arange(n)  # bytes up to it
        padded = np.concatenate((self.raw, np.zeros(8, np.uint8))).astype(np.uint64)
        self.eight = np.zeros(n, np.uint64)  # eight bytes from each place, big-endian
        for k in range(8):
            self.eight |= padded[k : n + k] << np.uint64(56 - 8 * k)


def larsson_sadakane(s: Segments) -> np.ndarray:
    """The suffix array: groups of equal prefixes are refined by the rank of what follows, doubling each time.

    Only groups of more than one suffix are sorted again.  A suffix that has met its end mark is
    told apart by its place.
    """
    n = len(s.raw)
    if not n:
        return np.empty(0, np.int64)
    shift = (np.uint64(8) * np.maximum(8 - s.left, 0).astype(np.uint64)).astype(np.uint64)
    key = np.where(s.left > 0, (s.eight >> np.minimum(shift, np.uint64(63))) << np.minimum(shift, np.uint64(63)), np.uint64(0))
    # Among equal bytes the shorter suffix is the smaller one, so zero bytes and ends stay apart.
    order = np.lexsort((np.minimum(s.left, 8), key))
    k, c = key[order], np.minimum(s.left, 8)[order]
    fresh = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = group
    h = 8
    while True:
        single = fresh & np.append(fresh[1:], True)
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            return order
        members = order[open_at]
        done = s.left[members] < h  # the end mark lies inside the prefix
        follow = np.where(done, members, rank[np.minimum(members + h, n - 1)])
        inner = np.lexsort((follow, group[open_at]))
        members, follow = members[inner], follow[inner]
        order[open_at] = members
        first = np.concatenate(([True], (follow[1:] != follow[:-1]) | (group[open_at][1:] != group[open_at][:-1])))
        fresh[open_at] = first
        group[open_at] = np.maximum.accumulate(np.where(first, open_at, 0))
        rank[members] = group[open_at]
        h *= 2


def kasai(s: Segments, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it.

    As in Kasai's algorithm a text position loses at most one byte against the position before.
    Where the bytes before both suffixes agree it loses exactly one; only the other positions
    are compared, eight bytes at a time, and a running maximum carries their values on.
    """
    n = len(order)
    if not n:
        return np.empty(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    carried = np.zeros(n, bool)
    inside = (at > 0) & (before > 0)
    i = at[inside]
    j = before[inside]
    carried[inside] = (s.raw[i - 1] == s.raw[j - 1]) & (s.left[i - 1] > 0) & (s.left[j - 1] > 0)
    compare = np.flatnonzero(~carried & (before >= 0))
    length = np.zeros(n, np.int64)
    most = np.minimum(s.left[compare], s.left[before[compare]])
    found = np.zeros(len(compare), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        a, b = compare[active] + found[active], before[compare[active]] + found[active]
        differ = s.eight[a] ^ s.eight[b]
        equal = np.full(len(active), 8, np.int64)
        some = differ != 0
        top = np.floor(np.log2((differ[some] >> np.uint64(32) << np.uint64(32)).astype(np.float64), where=(differ[some] >> np.uint64(32)) > 0, out=np.zeros(int(some.sum()))))
        low = np.floor(np.log2(np.maximum(differ[some] & np.uint64(0xFFFFFFFF), np.uint64(1)).astype(np.float64)))
        bit = np.where((differ[some] >> np.uint64(32)) > 0, top, low).astype(np.int64)
        equal[some] = 7 - bit // 8
        found[active] += equal
        active = active[(equal == 8) & (found[active] < most[active])]
    length[compare] = np.minimum(found, most)
    reach = np.where(carried, 0, at + length)
    plcp = np.maximum.accumulate(reach) - at
    return np.maximum(plcp, 0)[order]
