"""Words of whole texts as 64-bit hashes, a few million bytes at a time.

A word is a run of bytes other than white space (0x20, 0x09 to 0x0D) of the text in UTF-8, with
A-Z in lower case. Its hash is a polynomial over tables of random numbers, finished by a mixer;
two words that differ agree with a chance of 2^-64.
"""
from __future__ import annotations

import numpy as np

BATCH_ROWS = 1000
SLICE = 1 << 20  # bytes hashed together; a longer text is cut between words
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher, in place."""
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15) + U(seed))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTES = randoms(256, 7)
BYTES = BYTES[LOWER]
BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[U(1), np.full(n - 1, base, np.uint64)])


POWER = _powers(BASE, SLICE + 2)
INVERSE = _powers(pow(BASE, -1, 1 << 64), SLICE + 2)


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of at most ``SLICE`` bytes."""
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTES[data] * POWER[:len(data)], out=total[1:])
    found = (total[end] - total[start]) * INVERSE[start]
    return mix(found + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93)), start


def _long(data: np.ndarray) -> np.ndarray:
    """Hashes of one text of any length, slice by slice."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + SLICE, len(data))
        if end < len(data):
            gaps = np.flatnonzero(SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word of more than a slice: hashed with what follows, up to its end
                while end < len(data) and not SPACE[data[end]]:
                    end += 1
                word = LOWER[data[at:end]].tobytes()
                import hashlib

                parts.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64))
                at = end
                continue
        parts.append(_hashes(data[at:end])[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def word_hashes(texts: list[bytes]):
    """Yields, for runs of texts, the words' hashes one after the other and each text's count."""
    at = 0
    while at < len(texts):
        if len(texts[at]) >= SLICE:
            found = _long(np.frombuffer(texts[at], np.uint8))
            yield found, np.array([len(found)])
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) < SLICE:
            size += len(texts[end]) + 1
            end += 1
        joined = np.frombuffer(b" ".join(texts[at:end]), np.uint8)
        found, start = _hashes(joined)
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts[at:end])])
        yield found, np.diff(np.searchsorted(start, bounds))
        at = end


def shingles(found: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of runs of ``width`` words, sorted within each text, and their number.
    A text of fewer words has one run of them all, one without words has none."""
    n = len(found)
    text = np.repeat(np.arange(len(counts)), counts)
    runs = np.zeros(n, np.uint64)
    if n >= width:
        part = runs[:n - width + 1]
        for k in range(width):
            part *= U(BASE)
            part += found[k:n - width + 1 + k]
    last = np.cumsum(counts)
    ok = np.arange(n) + width <= last[text] if n else np.zeros(0, bool)
    for i in np.flatnonzero((counts > 0) & (counts < width)).tolist():
        a, b = int(last[i] - counts[i]), int(last[i])
        whole = U(b - a)
        with np.errstate(over="ignore"):
            for h in found[a:b]:
                whole = whole * U(BASE) + h
        runs[a], ok[a] = whole, True
    runs, text = mix(runs[ok] + U(width)), text[ok]
    sizes = np.bincount(text, minlength=len(counts))
    ends = np.cumsum(sizes)
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        runs[a:b].sort()
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    return runs[first], np.bincount(text[first], minlength=len(counts))


def short_batches(spark) -> None:
    """Texts are long: fewer rows travel to a Python task at once than Spark's 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
