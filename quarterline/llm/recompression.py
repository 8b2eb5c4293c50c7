"""Run-length grammars by recompression, and longest common extensions on them.

The sequence is rewritten until few symbols are left, blocks and pairs in turn: a block of one
symbol becomes one symbol, then symbols are dealt to a left and a right side by a hash, and each
left one that a right one follows is joined with it. Both rules look at neighbours only, so equal
stretches are rewritten alike but for their edges, and two positions are compared by going up
while both stand at the edge of a symbol, over at most one step aside on each level, and down
again to where they part. All queries take each level together, as arrays.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from quarterline.llm.words import U, mix

TOP = 8  # symbols at which rewriting ends; they are compared one by one


@dataclass
class Level:
    """One sequence: its symbols, each one's parent in the next, and the parents' first children."""
    symbols: np.ndarray
    parent: np.ndarray | None = None
    first: np.ndarray | None = None
    blocks: bool = False

    def mirrored(self) -> Level:
        if self.parent is None:
            return Level(self.symbols[::-1].copy())
        top = len(self.first) - 2
        return Level(self.symbols[::-1].copy(), top - self.parent[::-1], len(self.symbols) - self.first[::-1], self.blocks)


def _next(level: Level, starts: np.ndarray, blocks: bool) -> None:
    level.parent = np.cumsum(starts, dtype=np.int32) - np.int32(1)
    level.first = np.append(np.flatnonzero(starts), len(level.symbols)).astype(np.int32)
    level.blocks = blocks


def grammar(sequence: np.ndarray) -> list[Level]:
    """The levels over a sequence of numbers from 0, whose last symbol occurs once."""
    levels = [Level(sequence.astype(np.int32))]
    fresh, turn = int(sequence.max()) + 1 if len(sequence) else 0, 0
    while len(levels[-1].symbols) > TOP:
        level = levels[-1]
        s = level.symbols
        same = s[1:] == s[:-1]
        if same.any():
            _next(level, np.r_[True, ~same], True)
            up, size = s[level.first[:-1]].copy(), np.diff(level.first)
            long = np.flatnonzero(size > 1)
            name, named = np.unique(up[long].astype(np.int64) << 32 | size[long], return_inverse=True)
            up[long] = fresh + named
            fresh += len(name)
            levels.append(Level(up))
            continue
        turn += 1
        right = (mix(s.astype(np.uint64) + U(turn << 32)) & U(1)).astype(bool)
        joined, other = ~right[:-1] & right[1:], right[:-1] & ~right[1:]
        if np.count_nonzero(other) > np.count_nonzero(joined):
            joined = other
        at = np.flatnonzero(joined)
        if not len(at):
            continue
        starts = np.ones(len(s), bool)
        starts[at + 1] = False
        _next(level, starts, False)
        up = s[level.first[:-1]].copy()
        name, named = np.unique(s[at].astype(np.int64) << 32 | s[at + 1], return_inverse=True)
        up[level.parent[at]] = fresh + named
        fresh += len(name)
        levels.append(Level(up))
    return levels


def extensions(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many symbols agree from positions ``i`` and ``j`` on; ``i`` and ``j`` differ."""
    a, b = i.astype(np.int64), j.astype(np.int64)
    parted = np.full(len(a), len(levels) - 1)
    going = np.arange(len(a))
    for k, level in enumerate(levels[:-1]):
        x, y = a[going], b[going]
        same = level.symbols[x] == level.symbols[y]
        px, py = level.parent[x], level.parent[y]
        inside = same & ((level.first[px] != x) | (level.first[py] != y))
        if level.blocks:
            step = np.minimum(level.first[px + 1] - x, level.first[py + 1] - y)
        else:
            step = 1
        x, y = x + inside * step, y + inside * step
        px, py = level.parent[x], level.parent[y]
        up = same & (level.first[px] == x) & (level.first[py] == y)
        a[going], b[going] = np.where(up, px, x), np.where(up, py, y)
        parted[going[~up]] = k
        going = going[up]
    s = levels[-1].symbols
    while len(going):
        going = going[s[a[going]] == s[b[going]]]
        a[going] += 1
        b[going] += 1
    order = np.argsort(-parted, kind="stable")
    reached = np.searchsorted(-parted[order], -np.arange(len(levels)), side="right")
    for k in range(len(levels) - 1, 0, -1):
        level, down = levels[k - 1], order[:reached[k]]
        px, py = a[down], b[down]
        x, y = level.first[px].astype(np.int64), level.first[py].astype(np.int64)
        same = level.symbols[x] == level.symbols[y]
        step = np.minimum(level.first[px + 1] - x, level.first[py + 1] - y) if level.blocks else 1
        a[down], b[down] = x + same * step, y + same * step
    return a - i
