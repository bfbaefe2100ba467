"""Counting quotient filter over packed word-id n-grams, without loss.

An n-gram is n word ids of ``bits`` bits each.  Its ids are permuted by rounds that add a mix of the other ids to each of them (a Feistel
network, so that the permutation can be undone) and then read as one number of n * bits bits.  The first bits of that number name a range, which
is one filter; the next ones are the quotient, and all the rest is kept as the remainder, so that an entry gives its n-gram back.  The filter holds one bit
for each quotient that occurs, one for each entry that ends its quotient's run, the remainders in ascending order, and the counts in seven-bit
groups.  Filters of one range are sorted alike, so merging is one pass over their entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

from laurel.llm.common import mix64

ROUNDS = 2
U = np.uint64
#: Entries that are sorted at once when the filters of a range are merged, on average.
RUN = 1 << 18


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _steps(n: int) -> list[tuple[int, int]]:
    return [(r * n + j, j) for r in range(ROUNDS) for j in range(n)]


def _mix(ids: np.ndarray, j: int, seed: int, bits: int) -> np.ndarray:
    out = np.zeros(ids.shape[1], U)
    for i in range(len(ids)):
        if i != j:
            out = mix64(out + ids[i], seed * 8 + i)
    return out >> U(64 - bits)


def permute(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids: one row for each place of the n-gram."""
    out = ids.astype(U)
    for seed, j in _steps(len(out)):
        out[j] ^= _mix(out, j, seed, bits)
    return out


def unpermute(ids: np.ndarray, bits: int) -> np.ndarray:
    out = ids.astype(U)
    for seed, j in reversed(_steps(len(out))):
        out[j] ^= _mix(out, j, seed, bits)
    return out


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """The number of n * bits bits as 64-bit limbs, the highest first."""
    n, total = len(ids), len(ids) * bits
    out = np.zeros((-(-total // 64), ids.shape[1]), U)
    for j in range(n):
        low = (n - 1 - j) * bits  # place of the id's lowest bit, counted from the number's end
        limb, shift = len(out) - 1 - low // 64, low % 64
        out[limb] |= ids[j] << U(shift)
        if shift + bits > 64:
            out[limb - 1] |= ids[j] >> U(64 - shift)
    return out


def unpack(limbs: np.ndarray, n: int, bits: int) -> np.ndarray:
    out = np.empty((n, limbs.shape[1]), U)
    for j in range(n):
        low = (n - 1 - j) * bits
        limb, shift = len(limbs) - 1 - low // 64, low % 64
        out[j] = limbs[limb] >> U(shift)
        if shift + bits > 64:
            out[j] |= limbs[limb - 1] << U(64 - shift)
        out[j] &= _mask(bits)
    return out


def counted(limbs: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in ascending order, and how often each is there (or the sum of its counts)."""
    if counts is None and len(limbs) == 1:
        limbs = np.sort(limbs, axis=1)
    else:
        order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
        limbs = limbs[:, order]
    first = np.ones(limbs.shape[1], bool)
    first[1:] = (limbs[:, 1:] != limbs[:, :-1]).any(0)
    starts = np.flatnonzero(first)
    if counts is None:
        return limbs[:, starts], np.diff(np.append(starts, limbs.shape[1]))
    return limbs[:, starts], np.add.reduceat(counts[order], starts) if len(starts) else counts[:0]


def top(limbs: np.ndarray, total: int, skip: int, bits: int) -> np.ndarray:
    """bits bits of a number of total bits, behind the first skip ones."""
    low = total - skip - bits
    limb, shift = len(limbs) - 1 - low // 64, low % 64
    out = limbs[limb] >> U(shift)
    if shift + bits > 64:
        out = out | (limbs[limb - 1] << U(64 - shift))
    return out & _mask(bits)


def _varints(counts: np.ndarray) -> bytes:
    """Seven bits a byte, the lowest first; the high bit says that more follow."""
    left = counts.astype(U)
    width = np.ones(len(left), np.int64)
    for k in range(1, 10):
        width += left >> U(7 * k) > 0
    at = np.concatenate(([0], np.cumsum(width)))
    out = np.zeros(at[-1], np.uint8)
    for k in range(int(width.max(initial=0))):
        rows = width > k
        out[at[:-1][rows] + k] = ((left[rows] >> U(7 * k)) & U(127)).astype(np.uint8) | (np.where(width[rows] > k + 1, 128, 0).astype(np.uint8))
    return out.tobytes()


def _from_varints(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    place = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts) if len(ends) else np.zeros(0, np.int64)


@dataclass
class QuotientFilter:
    """n, bits: shape of the n-grams.  prefix, skip: the range's number and its bits.  limbs: ascending distinct numbers; counts: of each."""

    n: int
    bits: int
    prefix: int
    skip: int
    limbs: np.ndarray
    counts: np.ndarray

    @property
    def total(self) -> int:
        return self.n * self.bits

    def dump(self) -> bytes:
        m = self.limbs.shape[1]
        most = self.total - self.skip
        q = min(most, 48, max(1, m.bit_length()))
        rest = most - q
        width = -(-rest // 8)
        quotient = top(self.limbs, self.total, self.skip, q).astype(np.int64)
        occupied = np.zeros(1 << q, np.uint8)
        occupied[quotient] = 1
        ends = np.ones(m, np.uint8)
        ends[:-1] = quotient[1:] != quotient[:-1]
        low = np.empty((m, width), np.uint8)
        for b in range(width):  # byte b from the end
            take = min(8, rest - 8 * b)
            low[:, width - 1 - b] = top(self.limbs, self.total, self.total - 8 * b - take, take)
        head = np.array([self.n, self.bits, self.prefix, self.skip, m, q], "<i8")
        return b"".join([head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(), low.tobytes(), _varints(self.counts)])

    @classmethod
    def load(cls, data: bytes) -> QuotientFilter:
        n, bits, prefix, skip, m, q = (int(x) for x in np.frombuffer(data, "<i8", 6))
        raw, at = np.frombuffer(data, np.uint8), 48
        size = -(-(1 << q) // 8)
        quotients = np.flatnonzero(np.unpackbits(raw[at:at + size], count=1 << q))
        at += size
        size = -(-m // 8)
        ends = np.flatnonzero(np.unpackbits(raw[at:at + size], count=m))
        at += size
        total = n * bits
        rest = total - skip - q
        width = -(-rest // 8)
        low = raw[at:at + m * width].reshape(m, width)
        at += m * width
        limbs = np.zeros((-(-total // 64), m), U)

        def put(value: np.ndarray, place: int, size: int) -> None:
            limb, shift = len(limbs) - 1 - place // 64, place % 64
            limbs[limb] |= value << U(shift)
            if shift + size > 64:
                limbs[limb - 1] |= value >> U(64 - shift)

        for b in range(width):
            put(low[:, width - 1 - b].astype(U), 8 * b, min(8, rest - 8 * b))
        put(np.repeat(quotients, np.diff(np.concatenate(([-1], ends)))).astype(U), rest, q)
        if skip:
            put(np.full(m, prefix, U), total - skip, skip)
        return cls(n, bits, prefix, skip, limbs, _from_varints(raw[at:]))

    def ngrams(self) -> np.ndarray:
        """Word ids of the entries, a row for each place."""
        return unpermute(unpack(self.limbs, self.n, self.bits), self.bits)


def filters_of(ids: np.ndarray, bits: int, skip: int) -> list[QuotientFilter]:
    """One filter for each range that n-grams (a row for each place, repeated as they occur) fall in."""
    n = len(ids)
    skip = min(skip, n * bits)
    limbs, counts = counted(pack(permute(ids, bits), bits))
    return split(n, bits, skip, limbs, counts)


def split(n: int, bits: int, skip: int, limbs: np.ndarray, counts: np.ndarray) -> list[QuotientFilter]:
    if not limbs.shape[1]:
        return []
    range_ = top(limbs, n * bits, 0, skip).astype(np.int64) if skip else np.zeros(limbs.shape[1], np.int64)
    cuts = np.flatnonzero(np.diff(range_)) + 1
    return [QuotientFilter(n, bits, int(range_[a]), skip, limbs[:, a:b], counts[a:b]) for a, b in zip([0, *cuts], [*cuts, len(range_)])]


def merged(filters: list[QuotientFilter]) -> QuotientFilter:
    """Sum of filters of one range."""
    f = filters[0]
    limbs, counts = counted(np.concatenate([x.limbs for x in filters], 1), np.concatenate([x.counts for x in filters]).astype(np.int64, copy=False))
    return QuotientFilter(f.n, f.bits, f.prefix, f.skip, limbs, counts)


def merged_parts(filters: Iterable[QuotientFilter]) -> Iterator[QuotientFilter]:
    """Sum of filters of one range, in ascending stretches of it.

    Filters are added up as they come to runs of RUN entries.  A stretch is cut from all runs, so that beside these only what one stretch
    has is copied and sorted.
    """
    runs: list[QuotientFilter] = []
    held: list[QuotientFilter] = []

    def run() -> None:
        f = merged(held)
        held.clear()
        if f.counts.max(initial=0) < 1 << 32:
            f.counts = f.counts.astype(np.uint32)
        runs.append(f)

    size = 0
    for f in filters:
        held.append(f)
        size += len(f.counts)
        if size >= RUN:
            run()
            size = 0
    if held:
        run()
    if not runs:
        return
    f = runs[0]
    bits = min(f.total - f.skip, (sum(len(x.counts) for x in runs) // RUN).bit_length())
    cuts = [np.append(np.searchsorted(top(x.limbs, f.total, f.skip, bits), np.arange(1 << bits, dtype=U)), len(x.counts)) for x in runs]
    for i in range(1 << bits):
        yield merged([QuotientFilter(f.n, f.bits, f.prefix, f.skip, x.limbs[:, at[i]:at[i + 1]], x.counts[at[i]:at[i + 1]]) for x, at in zip(runs, cuts)])
