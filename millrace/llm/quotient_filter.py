"""Counting quotient filters without loss: exact counters of packed n-grams, small on the wire and merged in sorted order.

An n-gram of word ids is packed into one number of a fixed width, which an invertible permutation of that width spreads evenly. The first bits
of the permuted number name the shard, the next ones the quotient, and what is left is the full remainder, so a number can be read back
from where it stands and two n-grams never share a counter. Filters are kept sorted by the permuted number, so those of several tasks are merged
like sorted runs, whatever their number of quotients.

On the wire a filter has a bit for each quotient that occurs, a bit for each remainder that is the last of its quotient, the remainders, and one byte
for each count (eight more for counts of 255 and above).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits at the head of a permuted number that shards and quotients are taken from, and the narrowest number.
HEAD, NARROWEST = 32, 40
#: An odd factor of the permutation.
FACTOR = 0x9E3779B97F4A7C15
ROUNDS = 2
#: Counts from here on take eight bytes more.
LARGE = 255


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


@dataclass(frozen=True)
class Layout:
    """How n-grams of ``words`` ids of ``bits`` bits each become numbers, held in limbs of up to 64 bits, the first of which are the highest."""

    words: int
    bits: int

    @property
    def width(self) -> int:
        return max(NARROWEST, -(-self.words * self.bits // 8) * 8)

    @property
    def limbs(self) -> list[tuple[int, int]]:
        """The lowest bit and the width of each limb."""
        tops = range(self.width, 0, -64)
        return [(max(0, top - 64), min(64, top)) for top in tops]

    def packed(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for low, width in self.limbs:
            limb = np.zeros(len(ids[0]), np.uint64)
            for k, column in enumerate(ids):
                at = (self.words - 1 - k) * self.bits - low
                if -self.bits < at < width:
                    limb |= column << np.uint64(at) if at >= 0 else column >> np.uint64(-at)
            out.append(limb & _mask(width))
        return out

    def unpacked(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for k in range(self.words):
            value = np.zeros(len(limbs[0]), np.uint64)
            for limb, (low, width) in zip(limbs, self.limbs, strict=True):
                at = (self.words - 1 - k) * self.bits - low
                if -self.bits < at < width:
                    value |= limb >> np.uint64(at) if at >= 0 else limb << np.uint64(-at)
            out.append(value & _mask(self.bits))
        return out

    def permuted(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        """The number's place in the order of the filter; ``restored`` is the way back."""
        out = list(limbs)
        for _ in range(ROUNDS):
            for i, (_, width) in enumerate(self.limbs):
                if len(out) > 1:
                    out[i] = out[i] ^ (_mixed(out[i - 1]) & _mask(width))
                out[i] = (out[i] * np.uint64(FACTOR)) & _mask(width)
                out[i] = out[i] ^ (out[i] >> np.uint64(width - width // 2))
        return out

    def restored(self, limbs: list[np.ndarray]) -> list[np.ndarray]:
        out = list(limbs)
        for _ in range(ROUNDS):
            for i, (_, width) in reversed(list(enumerate(self.limbs))):
                out[i] = out[i] ^ (out[i] >> np.uint64(width - width // 2))
                out[i] = (out[i] * np.uint64(pow(FACTOR, -1, 1 << width))) & _mask(width)
                if len(out) > 1:
                    out[i] = out[i] ^ (_mixed(out[i - 1]) & _mask(width))
        return out

    def head(self, limbs: list[np.ndarray]) -> np.ndarray:
        return limbs[0] >> np.uint64(self.limbs[0][1] - HEAD)

    def to_bytes(self, limbs: list[np.ndarray]) -> np.ndarray:
        """One row of bytes for each number, the highest first."""
        parts = [limb.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width // 8 :] for limb, (_, width) in zip(limbs, self.limbs, strict=True)]
        return np.concatenate(parts, axis=1)

    def from_bytes(self, rows: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for _, width in self.limbs:
            full = np.zeros((len(rows), 8), np.uint8)
            full[:, 8 - width // 8 :] = rows[:, at : at + width // 8]
            out.append(full.view(">u8").reshape(-1).astype(np.uint64))
            at += width // 8
        return out


def _mixed(limb: np.ndarray) -> np.ndarray:
    limb = (limb ^ (limb >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return limb ^ (limb >> np.uint64(29))


@dataclass
class Filter:
    """Permuted numbers in order, each once, with their counts."""

    layout: Layout
    limbs: list[np.ndarray]
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.counts)

    @staticmethod
    def of(layout: Layout, limbs: list[np.ndarray], counts: np.ndarray | None = None) -> Filter:
        """A filter of permuted numbers in any order; equal ones add up."""
        size = len(limbs[0])
        if not size:
            return Filter(layout, limbs, np.zeros(0, np.int64))
        order = np.argsort(limbs[0], kind="stable") if len(limbs) == 1 else np.lexsort(limbs[::-1])
        limbs = [limb[order] for limb in limbs]
        first = np.ones(size, bool)
        first[1:] = np.logical_or.reduce([limb[1:] != limb[:-1] for limb in limbs])
        at = np.flatnonzero(first)
        sums = np.diff(np.append(at, size)) if counts is None else np.add.reduceat(counts[order], at)
        return Filter(layout, [limb[at] for limb in limbs], sums.astype(np.int64))

    @staticmethod
    def merged(filters: list[Filter]) -> Filter:
        layout = filters[0].layout
        return Filter.of(layout, [np.concatenate(x) for x in zip(*(f.limbs for f in filters), strict=True)], np.concatenate([f.counts for f in filters]))

    def where(self, chosen: np.ndarray) -> Filter:
        return Filter(self.layout, [limb[chosen] for limb in self.limbs], self.counts[chosen])

    def ids(self) -> list[np.ndarray]:
        return self.layout.unpacked(self.layout.restored(self.limbs))

    def shards(self, bits: int) -> list[tuple[int, bytes]]:
        """The parts of the filter by the first bits of its numbers, each on the wire."""
        if not len(self):
            return []
        shard = self.layout.head(self.limbs) >> np.uint64(HEAD - bits)
        starts = np.flatnonzero(np.diff(shard, prepend=shard[:1] + np.uint64(1)))
        rows = self.layout.to_bytes(self.limbs)
        heads = self.layout.head(self.limbs)
        return [(int(shard[a]), _wire(heads[a:b], rows[a:b], self.counts[a:b], bits)) for a, b in zip(starts, [*starts[1:], len(shard)], strict=True)]

    @staticmethod
    def from_wire(layout: Layout, shard: int, bits: int, wire: bytes) -> Filter:
        size, taken = (int(x) for x in np.frombuffer(wire, "<u4", 2))
        at = 8
        bitmap = np.frombuffer(wire, np.uint8, -(-(1 << taken) // 8), at)
        at += len(bitmap)
        ends = np.unpackbits(np.frombuffer(wire, np.uint8, -(-size // 8), at), count=size)
        at += -(-size // 8)
        fixed = (bits + taken) // 8
        rest = np.frombuffer(wire, np.uint8, size * (layout.width // 8 - fixed), at).reshape(size, -1)
        at += rest.size
        counts = np.frombuffer(wire, np.uint8, size, at).astype(np.int64)
        at += size
        large = counts == LARGE
        counts[large] = np.frombuffer(wire, "<i8", int(large.sum()), at)
        quotients = np.flatnonzero(np.unpackbits(bitmap, count=1 << taken))[np.cumsum(ends) - ends]
        heads = (np.uint64(shard) << np.uint64(taken)) | quotients.astype(np.uint64)
        prefix = heads.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - fixed :]
        return Filter(layout, layout.from_bytes(np.concatenate([prefix, rest], axis=1)), counts)


def _wire(heads: np.ndarray, rows: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    size = len(counts)
    taken = max(0, size.bit_length() - 4)  # up to 16 numbers a quotient, so that remainders begin with a byte
    taken = min(taken + -(bits + taken) % 8, HEAD - bits)
    quotients = (heads >> np.uint64(HEAD - bits - taken)) & _mask(taken)
    bitmap = np.zeros(1 << taken, np.uint8)
    bitmap[quotients.astype(np.int64)] = 1
    ends = np.append(quotients[1:] != quotients[:-1], True)
    large = counts >= LARGE
    return b"".join(
        (
            np.array([size, taken], "<u4").tobytes(),
            np.packbits(bitmap).tobytes(),
            np.packbits(ends).tobytes(),
            np.ascontiguousarray(rows[:, (bits + taken) // 8 :]).tobytes(),
            np.minimum(counts, LARGE).astype(np.uint8).tobytes(),
            counts[large].astype("<i8").tobytes(),
        )
    )
