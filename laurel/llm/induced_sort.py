"""Suffix sorting by recursive induction over queues that go to disk beyond a size.

A suffix is of type S if it is smaller than the one that begins a place later, else of type L; S suffixes right of an L suffix are the
seeds.  Sorted seeds induce all L suffixes in one pass from the left and then all S suffixes in one from the right.  Seeds are sorted the
same way: equal stretches between seeds get equal names, and the string of names is suffix-sorted recursively.

The priority queue of a pass is one file-backed array, divided by leading symbol: suffixes reach a part in sorted order, so taking
the least one is reading on.  Each pass takes as many as it can before the first place that one of them fills, as whole arrays, and queues
beyond a size are memory maps in a scratch folder, read and written once from end to end.  Symbols, types and numbers of suffixes stay in memory.
"""

import os
import uuid

import numpy as np

#: Entries of an array above which it goes to disk.
IN_MEMORY = 1 << 24
#: Most entries of a queue that one step takes.
STEP = 1 << 18


def array(n: int, kind: np.dtype, scratch: str | None) -> np.ndarray:
    """An array of n entries; a large one is a file of the scratch folder, gone as soon as nothing refers to it."""
    if n <= IN_MEMORY or scratch is None:
        return np.empty(n, kind)
    os.makedirs(scratch, exist_ok=True)
    path = os.path.join(scratch, f"queue-{uuid.uuid4().hex}")
    out = np.memmap(path, kind, "w+", shape=(n,))
    os.unlink(path)
    return out


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Type S: the next different symbol is larger; the last suffix, the least of all, counts as S."""
    n = len(t)
    out = np.empty(n, bool)
    out[-1] = True
    differs = np.flatnonzero(t[1:] != t[:-1])
    up = t[differs + 1] > t[differs]
    # each run of equal symbols has the type of its end
    start = 0
    which = np.searchsorted(differs, np.arange(start, n - 1)) if n > 1 else np.zeros(0, np.int64)
    out[:-1] = np.append(up, True)[which]
    return out


class Queue:
    """Suffixes by leading symbol; a pass fills each symbol's part from one end."""

    def __init__(self, t: np.ndarray, symbols: int, scratch: str | None):
        self.t, self.kind = t, np.int64 if len(t) >= 1 << 31 else np.int32
        self.ends = np.cumsum(np.bincount(t, minlength=symbols))
        self.starts = self.ends - np.diff(self.ends, prepend=0)
        self.sa = array(len(t), self.kind, scratch)

    def put(self, at: np.ndarray, place: np.ndarray, step: int) -> None:
        """Suffixes at, in their order, to the free places of their symbols; place moves on by step for each."""
        symbol, n = self.t[at], len(at)
        order = symbol.argsort(kind="stable")
        s = symbol[order]
        new = np.empty(n, bool)
        new[0] = True
        np.not_equal(s[1:], s[:-1], out=new[1:])
        first = new.nonzero()[0]
        count = np.empty(len(first), np.int64)
        np.subtract(first[1:], first[:-1], out=count[:-1])
        count[-1] = n - first[-1]
        rank = np.arange(n) - first.repeat(count)
        self.sa[place[s] + step * rank] = at[order]
        place[s[first]] += step * count

    def induce(self, seeds: np.ndarray, type_s: np.ndarray) -> np.ndarray:
        """All suffixes in the order that follows from that of the seeds."""
        sa, t, n = self.sa, self.t, len(self.t)
        sa[:] = -1
        self.put(seeds[::-1], self.ends - 1, -1)
        self._pass(type_s, True)
        # only the seeds' order was needed; S suffixes are placed anew from the right
        for i in range(0, n, STEP):
            part = sa[i:i + STEP]
            part[(part >= 0) & type_s[np.maximum(part, 0)]] = -1
        sa[0] = n - 1
        self._pass(type_s, False)
        return sa

    def _pass(self, type_s: np.ndarray, forward: bool) -> None:
        """L suffixes from the left, or S suffixes from the right."""
        sa, t, n = self.sa, self.t, len(self.t)
        place = self.starts.copy() if forward else self.ends - 1
        step = 1 if forward else -1
        at, width = (0, 64) if forward else (n - 1, 64)
        while 0 <= at < n:
            stop = min(at + width, n) if forward else max(at - width, -1)
            window = sa[at:stop] if forward else sa[stop + 1:at + 1][::-1]
            before = window - 1
            go = ((window > 0) & (type_s[before] != forward)).nonzero()[0]  # -1 and -2 look at some type, and don't go
            if len(go):
                target = place[t[before[go]]]
                first = int(target.min()) if forward else int(target.max())
                if (first < stop) if forward else (first > stop):
                    # entries up to the first place that gets filled are final, those behind it wait
                    stop = max(first, at + 1) if forward else min(first, at - 1)
                    go = go[go < abs(stop - at)]
                    width = max(64, abs(stop - at))
                if len(go):
                    self.put(before[go], place, step)
            width = min(STEP, width * 2)
            at = stop


def seeds_of(type_s: np.ndarray) -> np.ndarray:
    return np.flatnonzero(type_s[1:] & ~type_s[:-1]) + 1


def equal_neighbours(t: np.ndarray, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether stretches t[a:a + size_a] and t[b:b + size_b] are equal."""
    same = size_a == size_b
    left = np.flatnonzero(same)
    k = 0
    while len(left):
        ok = t[a[left] + k] == t[b[left] + k]
        same[left[~ok]] = False
        k += 1
        left = left[ok & (size_a[left] > k)]
    return same


def suffix_array(t: np.ndarray, symbols: int, scratch: str | None = None) -> np.ndarray:
    """Places of all suffixes of t in sorted order.  The last symbol has to be 0 and occur just there."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    type_s = smaller_than_next(t)
    seeds = seeds_of(type_s)
    queue = Queue(t, symbols, scratch)
    # any order of the seeds puts the stretches between them in order
    sa = queue.induce(seeds, type_s)
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    ordered = sa[is_seed[sa]]
    number = np.empty(n, queue.kind)
    number[seeds] = np.arange(len(seeds))
    at = number[ordered].astype(np.int64)
    size = np.append(np.diff(seeds) + 1, 1)[at]
    fresh = np.concatenate(([True], ~equal_neighbours(t, ordered[:-1].astype(np.int64), ordered[1:].astype(np.int64), size[:-1].copy(), size[1:])))
    names = np.cumsum(fresh) - 1
    if names[-1] + 1 < len(seeds):
        short = array(len(seeds), np.int64, scratch)
        short[at] = names
        del sa, number
        ordered = seeds[suffix_array(short, int(names[-1]) + 1, scratch)]
    return queue.induce(ordered, type_s)


def common_prefix(t: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefix length of the suffixes at a and b, counted up to most; t has most symbols behind each."""
    out = np.full(len(a), most, np.int64)
    left = np.arange(len(a))
    for k in range(most):
        ok = t[a[left] + k] == t[b[left] + k]
        out[left[~ok]] = k
        left = left[ok]
        if not len(left):
            break
    return out
