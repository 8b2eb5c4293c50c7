"""Open-addressed table of n-grams in NumPy, for one batch of text at a time.

An n-gram is a span of bytes. Its key is xxhash64; a span that meets its own key in the table is
compared with the entry byte by byte, and goes on to the next place where the bytes differ. Each
entry holds the n-gram's bucket and how often it occurs; the spans get their entries' numbers.
All spans take each step together, as arrays.
"""
from __future__ import annotations

import zlib

import numpy as np
import xxhash

U = np.uint64
P1, P2, P3, P4, P5 = map(U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SHORT = 32  # bytes from which a key or checksum is asked of the library, span by span
PAD = 8


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << U(by) | x >> U(64 - by)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


CRC = _crc_table()


class Spans:
    """Spans of a text, given by their first bytes and lengths."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.data = np.concatenate([data, np.zeros(PAD, np.uint8)])
        self.start, self.length = start, length
        # eight bytes from every place on, so that a lane is one look-up
        self.eight = np.ndarray(len(self.data) - PAD + 1, "<u8", self.data, strides=(1,)).copy()

    def lane(self, of: np.ndarray, at: int) -> np.ndarray:
        """The eight bytes from ``at`` on, those beyond a span's end as zeros."""
        left = self.length[of] - at
        found = self.eight[self.start[of] + at]
        part = left < 8
        found[part] &= (U(1) << (left[part] * 8).astype(U)) - U(1)
        return found

    def bytes(self, of: int) -> bytes:
        return self.data[self.start[of]:self.start[of] + self.length[of]].tobytes()

    def keys(self) -> np.ndarray:
        """xxhash64 of each span, seed 0."""
        n = self.length
        h = n.astype(U) + P5
        for at in range(0, SHORT - 8, 8):
            on = np.flatnonzero((n >= at + 8) & (n < SHORT))
            if not len(on):
                break
            x = self.eight[self.start[on] + at] * P2
            h[on] = _turned(h[on] ^ _turned(x, 31) * P1, 27) * P1 + P4
        at = n & ~7
        on = np.flatnonzero((n & 4 > 0) & (n < SHORT))
        x = self.eight[self.start[on] + at[on]] & U(0xFFFFFFFF)
        h[on] = _turned(h[on] ^ x * P1, 23) * P2 + P3
        at[on] += 4
        for k in range(3):
            on = np.flatnonzero((n & 3 > k) & (n < SHORT))
            x = self.data[self.start[on] + at[on] + k].astype(U)
            h[on] = _turned(h[on] ^ x * P5, 11) * P1
        h ^= h >> U(33)
        h *= P2
        h ^= h >> U(29)
        h *= P3
        h ^= h >> U(32)
        for i in np.flatnonzero(n >= SHORT).tolist():
            h[i] = xxhash.xxh64_intdigest(self.bytes(i))
        return h

    def checksums(self, of: np.ndarray) -> np.ndarray:
        """crc32 of some spans."""
        start, n = self.start[of], self.length[of]
        c = np.full(len(of), 0xFFFFFFFF, np.uint32)
        for k in range(min(int(n.max(initial=0)), SHORT - 1)):
            on = np.flatnonzero((n > k) & (n < SHORT))
            x = c[on]
            c[on] = CRC[(x ^ self.data[start[on] + k]) & 255] ^ x >> 8
        c = ~c
        for i in np.flatnonzero(n >= SHORT).tolist():
            c[i] = zlib.crc32(self.bytes(of[i]))
        return c

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans have the same bytes."""
        same = self.length[a] == self.length[b]
        on, at = np.flatnonzero(same), 0
        while len(on):
            differ = self.lane(a[on], at) != self.lane(b[on], at)
            same[on[differ]] = False
            at += 8
            on = on[~differ]
            on = on[self.length[a[on]] > at]
        return same


class Table:
    """The n-grams of a batch: ``slots`` of the spans, and by slot ``bucket`` and ``count``."""

    def __init__(self, spans: Spans, buckets: int, keys: np.ndarray | None = None):
        keys = spans.keys() if keys is None else keys
        n = len(keys)
        size = 1 << max(4, (2 * n - 1).bit_length())
        place = np.full(size, -1, np.int64)  # the span that stands for an entry
        at = (keys & U(size - 1)).astype(np.int64)
        self.slots = np.empty(n, np.int64)
        waiting = np.arange(n)
        while len(waiting):
            here = at[waiting]
            free = place[here] < 0
            place[here[free]] = waiting[free]  # of several that come at once one stays
            there = place[here]
            hit = keys[there] == keys[waiting]
            hit[hit] = spans.equal(there[hit], waiting[hit])
            self.slots[waiting[hit]] = here[hit]
            waiting = waiting[~hit]
            at[waiting] = at[waiting] + 1 & size - 1
        used = np.flatnonzero(place >= 0)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[used] = spans.checksums(place[used]) % buckets
        self.count = np.bincount(self.slots, minlength=size)
