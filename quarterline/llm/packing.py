"""Arrays of whole numbers and doubles in one short binary."""
from __future__ import annotations

import struct

import numpy as np
import zstandard

#: a code for each kind, in the order of its widths
KINDS = ["u1", "u2", "u4", "u8", "f8"]


def pack(*arrays: np.ndarray) -> bytes:
    """Numbers from 0 at the least width that holds them, byte by byte of equal weight, as those of
    sorted or small numbers are much alike."""
    head, parts = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        a = np.asarray(a)
        if a.dtype.kind != "f":
            top = int(a.max()) if len(a) else 0
            kind = next(k for k, bits in enumerate((8, 16, 32, 64)) if top < 1 << bits)
        else:
            kind = 4
        a = np.ascontiguousarray(a, "<" + KINDS[kind])
        head.append(struct.pack("<BQ", kind, len(a)))
        parts.append(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(head + parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    at, shapes, found = 1, [], []
    for _ in range(data[0]):
        shapes.append(struct.unpack_from("<BQ", data, at))
        at += 9
    for kind, n in shapes:
        t = np.dtype("<" + KINDS[kind])
        planes = np.frombuffer(data, np.uint8, n * t.itemsize, at).reshape(t.itemsize, n)
        found.append(np.ascontiguousarray(planes.T).view(t).ravel())
        at += n * t.itemsize
    return found


def steps(sorted_: np.ndarray) -> np.ndarray:
    """Differences of sorted 64-bit numbers, the first to 0."""
    return np.diff(sorted_.astype(np.uint64), prepend=np.uint64(0))


def sums(differences: np.ndarray) -> np.ndarray:
    return np.cumsum(differences.astype(np.uint64), dtype=np.uint64)
