"""Byte-level BPE encoding of whole texts inside a task.

A text is cut at its spaces, and what follows a space is encoded once and remembered: a
byte-level pre-token never reaches over a single space, so such pieces encode alike in every
text. Pieces where that doesn't hold (white space beside a space) send their text through the
plain path. The memory is emptied when it reaches its bound, which costs time only.

Two ways of encoding a word stand behind it: ``SegmentTreeWords`` applies the merges itself, to
the new words of many texts together; ``LibraryWords`` asks the tokenizers library's model for one
word, when a text first comes to it.
"""
from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain
from struct import pack

import numpy as np

#: Characters below it are classified here; beyond it the library's pre-tokenizer decides, as
#: the letters and digits it knows depend on its Unicode version.
PLAIN_LIMIT = 0x530
#: characters encoded together
STRIDE = 1_500_000
NONE = np.iinfo(np.int64).max


def _ranges(kind: str) -> str:
    """The characters of a general category as text for a character class."""
    codes = [i for i in range(PLAIN_LIMIT) if unicodedata.category(chr(i))[0] == kind]
    runs: list[list[int]] = []
    for i in codes:
        if runs and runs[-1][1] == i - 1:
            runs[-1][1] = i
        else:
            runs.append([i, i])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


def _pattern() -> re.Pattern:
    letter, digit, space = _ranges("L"), _ranges("N"), r"\t-\r \x85\xa0"
    # fixed values: the contractions and the order of alternatives of byte-level pre-tokens
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+")


PRETOKENS = _pattern()
BEYOND = re.compile(f"[^\\x00-\\u{PLAIN_LIMIT - 1:04x}]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class SegmentTreeWords:
    """Applies the merges of a vocabulary to words of bytes.

    The leaves of a segment tree hold, for each adjacent pair of symbols, its rank and place;
    the root is the leftmost pair of the lowest rank. A merge changes three leaves and the
    nodes above them. Words of about one length go through their trees together; a word of
    over ``WIDE`` bytes has a tree to itself.
    """

    MEMORY = 150_000  # words remembered
    WIDE = 64

    def __init__(self, tokenizer_json: str):
        model = json.loads(tokenizer_json)["model"]
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 20 | right
        order = np.argsort(keys, kind="stable")
        first = np.r_[True, np.diff(keys[order]) != 0]
        self.keys, self.ranks, self.made = keys[order][first], order[first], made
        self.table = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        self.start = np.array([vocab[c] for c in byte_characters()], np.int64)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        sizes: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w)
            if n > self.WIDE:
                out[i] = self._long(w)
            elif n:
                sizes.setdefault(max(1, 1 << (n - 2).bit_length() if n > 2 else 1), []).append(i)
        for leaves, own in sizes.items():
            for at in range(0, len(own), 16_384):
                part = own[at:at + 16_384]
                for i, ids in zip(part, self._together([words[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NONE`` for pairs that do not merge or lack a side."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def _together(self, words: list[bytes], leaves: int) -> list[bytes]:
        n, width = len(words), leaves + 2
        lengths = np.fromiter(map(len, words), np.int64, n)
        flat = self.start[np.frombuffer(b"".join(words), np.uint8)]
        # one column more at either end: no symbol stands there
        symbol = np.full((n, width + 1), -1, np.int64)
        inside = np.arange(width)[None, :] < lengths[:, None]
        symbol[:, :width][inside] = flat
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        shift = max(1, leaves.bit_length())
        place = np.arange(leaves)
        rank = self._rank(symbol[:, :leaves], symbol[:, 1:leaves + 1])
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        tree[:, leaves:] = np.where(rank == NONE, NONE, rank << shift | place)
        for node in range(leaves - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        root = 1
        rows = np.flatnonzero(tree[:, root] != NONE)
        while len(rows):
            top = tree[rows, root]
            i = top & ((1 << shift) - 1)
            j = after[rows, i]
            k = after[rows, j]
            h = before[rows, i]
            symbol[rows, i] = self.made[top >> shift]
            symbol[rows, j] = -1
            after[rows, i] = k
            before[rows, np.minimum(k, width)] = i
            new = symbol[rows, i]
            right = self._rank(new, symbol[rows, np.minimum(k, width)])
            left = np.where(h >= 0, self._rank(symbol[rows, np.maximum(h, 0)], new), NONE)
            tree[rows, leaves + i] = np.where(right == NONE, NONE, right << shift | i)
            has_j = j < leaves
            tree[rows[has_j], leaves + j[has_j]] = NONE
            has_h = h >= 0
            tree[rows[has_h], leaves + h[has_h]] = np.where(
                left == NONE, NONE, left << shift | h)[has_h]
            for leaf in (i, np.minimum(j, leaves - 1), np.maximum(h, 0)):
                node = (leaves + leaf) >> 1
                while node[0] >= 1:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
            rows = rows[tree[rows, root] != NONE]
        kept = symbol >= 0
        counts = kept.sum(1)
        data = symbol[kept].astype("<u4").tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _long(self, word: bytes) -> bytes:
        symbol = self.start[np.frombuffer(word, np.uint8)].tolist()
        n = len(symbol)
        leaves = 1 << (n - 1).bit_length()
        none = (1 << 62, 0)
        find = self.table.get

        def pair(a: int, b: int) -> tuple[int, int]:
            r = find(symbol[a] << 20 | symbol[b]) if 0 <= a and b < n else None
            return none if r is None else (r, a)

        tree = [none] * leaves + [pair(i, i + 1) for i in range(n - 1)] + [none] * (leaves - n + 1)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made = self.made

        def put(leaf: int, value: tuple[int, int]) -> None:
            node = leaves + leaf
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        while tree[1] != none:
            rank, i = tree[1]
            j = after[i]
            symbol[i], symbol[j] = int(made[rank]), -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            put(j, none)
            put(i, pair(i, k))
            if before[i] >= 0:
                put(before[i], pair(before[i], i))
        return np.array([s for s in symbol if s >= 0], "<u4").tobytes()


class LibraryWords:
    """Asks the tokenizers library's model for the ids of a word."""

    MEMORY = 600_000

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer_json).model
        self.shown = dict(enumerate(byte_characters()))
        self.space = self.shown[0x20]

    def one(self, word: str) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit integers."""
        if word.isascii() and word.isprintable():
            shown = word.replace(" ", self.space)
        else:
            shown = word.encode().decode("latin-1").translate(self.shown)
        ids = [x.id for x in self.model.tokenize(shown)]
        return pack(f"<{len(ids)}I", *ids)


class _Learnt(dict):
    """Remembers what ``learn`` says of a key that is new."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, key):
        found = self[key] = self.learn(key)
        return found


class TextEncoder:
    """Whole texts to ids, equal to the tokenizers library's for a byte-level BPE file."""

    def __init__(self, tokenizer_json: str, words):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        kind = spec["pre_tokenizer"] or {}
        if kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without prefix space and normalizer is needed")
        self.words = words
        self.batched = not hasattr(words, "one")
        self.pre_tokenizer = Tokenizer.from_str(tokenizer_json).pre_tokenizer
        added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.added = added
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        first = {content[0] for content in added}
        self.mark = min(first) if len(first) == 1 else ""  # in any text that has an added token
        self.plain = not any(c.isalpha() for c in first)  # letters alone hold no added token
        # what follows a space; None: needs its text
        self.spaced: dict[str, bytes | None] = {} if self.batched else _Learnt(self._piece)
        self.known: dict[str, bytes] = {} if self.batched else _Learnt(words.one)

    def _pretokens(self, text: str) -> list[str]:
        if text.isascii() or not BEYOND.search(text):
            return PRETOKENS.findall(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]

    def _cut(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a text, in order."""
        if self.special is None or self.mark not in text or not self.special.search(text):
            return self._pretokens(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([p] if p in self.added else self._pretokens(p) for p in parts if p))

    def _learn(self, cuts: list[list[str]]) -> None:
        new = list(set(chain.from_iterable(cuts)).difference(self.known))
        self.known.update(zip(new, self.words.encode([w.encode() for w in new])))
        self.known.update(self.added)

    def _forget(self) -> None:
        if len(self.spaced) > 2 * self.words.MEMORY or len(self.known) > self.words.MEMORY:
            self.spaced.clear()
            self.known.clear()

    def _joined(self, cut: list[str]) -> bytes:
        """The ids of pre-tokens and added tokens."""
        known = self.known
        if len(cut) == 1 and cut[0] not in self.added:
            return known[cut[0]]
        return b"".join([self.added[p] if p in self.added else known[p] for p in cut])

    def _piece(self, piece: str) -> bytes | None:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        if self.plain and piece.isalpha() and piece.isascii():  # one pre-token
            return self.known[" " + piece]
        return self._joined(self._cut(" " + piece))

    def _one(self, text: str) -> bytes:
        self._forget()
        head, *rest = text.split(" ")
        if not (head[:1].isspace() or head[-1:].isspace()):
            try:
                return self._joined(self._cut(head)) + b"".join(map(self.spaced.__getitem__, rest))
            except TypeError:  # white space beside a space
                pass
        return self._joined(self._cut(text))

    def _together(self, texts: list[str]) -> list[bytes]:
        self._forget()
        pieces = [t.split(" ") for t in texts]
        heads = [p[0] for p in pieces]
        new = set(chain.from_iterable(pieces)).difference(self.spaced)
        odd = {c for c in new if not c or c[0].isspace() or c[-1].isspace()}
        new = list(new - odd)
        cuts = [self._cut(" " + c) for c in new]
        plain = [not any(map(str.isspace, (h[:1], h[-1:]))) for h in heads]
        head_cuts = [self._cut(h) if h and ok else [] for h, ok in zip(heads, plain)]
        self._learn([*cuts, *head_cuts])
        known, spaced = self.known.__getitem__, self.spaced
        for c, cut in zip(new, cuts):
            spaced[c] = b"".join(map(known, cut))
        spaced.update(dict.fromkeys(odd))
        out = []
        for text, p, ok, cut in zip(texts, pieces, plain, head_cuts):
            del p[0]
            try:
                if not ok:
                    raise TypeError
                out.append(b"".join(map(known, cut)) + b"".join(map(spaced.__getitem__, p)))
            except TypeError:  # white space beside a space
                whole = self._cut(text)
                self._learn([whole])
                out.append(b"".join(map(known, whole)))
        return out

    def encode(self, texts: list[str]):
        """Yields the ids of each text as bytes of little-endian unsigned 32-bit integers."""
        if not self.batched:
            yield from map(self._one, texts)
            return
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t)
            if size >= STRIDE:
                yield from self._together(part)
                part, size = [], 0
        if part:
            yield from self._together(part)


_ENCODERS: dict[tuple[str, int], TextEncoder] = {}


def encoder(tokenizer_json: str, words) -> TextEncoder:
    """One encoder for each Python worker, kept from task to task."""
    key = (words.__name__, hash(tokenizer_json))
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(tokenizer_json, words(tokenizer_json))
    return _ENCODERS[key]


def read_tokenizer(path: str) -> str:
    """A tokenizer file's text, for a broadcast. Its size is checked."""
    with open(path, encoding="utf-8") as f:
        text = f.read(64 << 20)
        if f.read(1):
            raise ValueError(f"{path} is over 64 MB")
    return text
