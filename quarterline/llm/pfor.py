"""Blocks of unsigned integers in patched frame-of-reference form.

A block subtracts its minimum and packs all values at the width that a percentile of them
needs; the rest, which need more bits, keep their low bits there and stand whole in an
exception list. ``pack_blocks`` gives the blocks of an array, ``unpack_block`` reads one.

Layout of a block, little-endian: minimum u32, values u32, width u8, exceptions u32, the packed
bits (eight values take ``width`` bytes), the exceptions' places u16 and their values u32.
"""
from __future__ import annotations

import struct

import numpy as np

BLOCK = 4096  # values a block; places of exceptions are u16
PERCENTILE = 0.98
HEAD = struct.Struct("<IIBI")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values, a multiple of 8 long, to rows of packed bytes."""
    n, m = values.shape
    if width == 0:
        return np.zeros((n, 0), np.uint8)
    if width > 16:
        bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)).astype(np.uint8) & 1
        return np.packbits(bits.reshape(n, -1), axis=1, bitorder="little")
    v = values.reshape(n, m // 8, 8).astype(np.uint64)
    w = np.uint64(width)
    low = v[..., 0] | v[..., 1] << w | v[..., 2] << w * 2 | v[..., 3] << w * 3
    high = v[..., 4] | v[..., 5] << w | v[..., 6] << w * 2 | v[..., 7] << w * 3
    out = np.empty((n, m // 8, width), np.uint8)
    for j in range(width):
        byte = low >> np.uint64(8 * j) if 8 * j < 4 * width else np.uint64(0)
        shift = 4 * width - 8 * j
        if shift < 8:  # the byte reaches into the upper four values
            byte = byte | (high << np.uint64(shift) if shift >= 0 else high >> np.uint64(-shift))
        out[..., j] = (byte & np.uint64(255)).astype(np.uint8)
    return out.reshape(n, -1)


def _unpack(data: np.ndarray, width: int, count: int) -> np.ndarray:
    if width == 0:
        return np.zeros(count, np.uint32)
    if width > 16:
        bits = np.unpackbits(data, bitorder="little").reshape(-1, width).astype(np.uint32)
        return (bits << np.arange(width, dtype=np.uint32)).sum(1, dtype=np.uint32)[:count]
    groups = data.reshape(-1, width).astype(np.uint64)
    low = np.zeros(len(groups), np.uint64)
    high = np.zeros(len(groups), np.uint64)
    for j in range(width):
        at, shift = 8 * j, 4 * width - 8 * j
        if at < 4 * width:
            low |= groups[:, j] << np.uint64(at)
        if shift < 8:
            high |= groups[:, j] >> np.uint64(shift) if shift >= 0 else groups[:, j] << np.uint64(-shift)
    mask, w = np.uint64((1 << width) - 1), np.uint64(width)
    out = np.empty((len(groups), 8), np.uint32)
    for i in range(4):
        out[:, i] = low >> w * np.uint64(i) & mask
        out[:, 4 + i] = high >> w * np.uint64(i) & mask
    return out.reshape(-1)[:count]


def pack_blocks(values: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks of an array of unsigned 32-bit integers, in order."""
    values = np.ascontiguousarray(values, np.uint32)
    whole = len(values) // BLOCK * BLOCK
    blocks = _rows(values[:whole].reshape(-1, BLOCK), percentile) if whole else []
    return blocks + (_rows(values[whole:].reshape(1, -1), percentile) if whole < len(values) else [])


def _rows(rows: np.ndarray, percentile: float) -> list[bytes]:
    n, count = rows.shape
    low = rows.min(1)
    rest = rows - low[:, None]
    at = min(count - 1, int(percentile * count))
    width = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1]  # bit lengths
    out: list[bytes] = [b""] * n
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        part = rest[own]
        over = part >> np.uint32(w) != 0 if w < 32 else np.zeros(part.shape, bool)
        cut = part & np.uint32((1 << w) - 1)
        packed = _pack(np.pad(cut, ((0, 0), (0, -count % 8))), w)
        for k, row in enumerate(own.tolist()):
            places = np.flatnonzero(over[k])
            out[row] = b"".join((
                HEAD.pack(int(low[row]), count, w, len(places)), packed[k].tobytes(),
                places.astype("<u2").tobytes(), part[k][places].astype("<u4").tobytes()))
    return out


def unpack_block(data: bytes) -> np.ndarray:
    low, count, width, exceptions = HEAD.unpack_from(data)
    size = -(-count // 8) * width
    at = HEAD.size
    values = _unpack(np.frombuffer(data, np.uint8, size, at), width, count)
    at += size
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, at)
        values[places] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return values + np.uint32(low)
