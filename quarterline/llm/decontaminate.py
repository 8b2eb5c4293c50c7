"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits of any script, with their marks, A-Z in lower case; in scripts
without spaces between words (Chinese, Japanese, Thai, Lao, Khmer, Myanmar) each letter is a token.
Documents are joined with benchmark items on seeds, runs of ``seed`` tokens that both hold; an item
of fewer tokens is its own seed, so it leaks where a document holds it whole. Where the tokens under
seeds could cover enough of an item, document and item are tiled: running Karp-Rabin looks for common runs of
unmarked tokens from long to short, and the longest that don't overlap are marked. An item is
leaked where its tiles cover ``coverage`` of its tokens, in whatever order they stand.

The benchmark's distinct texts are written by tasks in blocks of a checked size (``BLOCK_BYTES``) to the
shared folder; its text never passes through the driver. The documents are read once: a task meets
some of its batches with one block after the other, of which it holds one, so documents are never
shuffled and their copies, hot passages and long texts stay where they are. More benchmark means
more reading of blocks, not more memory. Where text and item repeat themselves, common runs are
found by their lengths and not listed window by window, so memory goes with the text.

Null and empty texts and those without tokens match nothing; null item ids are kept as ids. Repeated rows give repeated
rows. Other columns are not read, or pass through where documents are filtered. An empty table
on either side gives no leaks.
"""
from __future__ import annotations

import pickle
import re
import unicodedata
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.words import BASE, U, word_hashes
from quarterline.plans.lineage import materialise, new_path

SEED = 5
COVERAGE = 0.5
PAIRS = 1 << 20  # of equal windows of one item and text that are listed; more are met token by token
BLOCK_BYTES = 16 << 20
HELD_BYTES = 32 << 20
#: Of one byte: all but letters and digits count as space. What is left of longer characters counts as letters.
CLEAN = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 0x20 for b in range(256))

SIGNS = re.compile(r"[^\w\x00-\x7f]")
#: Letters of scripts without spaces, with the marks among them, without their digits.
SINGLES = re.compile("[\u0e00-\u0e4f\u0e80-\u0ecf\u0edc-\u0eff\u1000-\u103f\u104a-\u108f\u109a-\u109f\u1780-\u17df"
                     "\u3005-\u3007\u3021-\u3035\u3038-\u303c\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9ef\ua9fa-\ua9fe"
                     "\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff]+")

LEAK = "doc_id long, item_id long, item_tokens long, matched_tokens long, coverage double, tiles long, longest long"


def _mark(c: str) -> bool:
    return unicodedata.category(c)[0] == "M"


def spaced(text: bytes) -> bytes:
    """A text with its tokens between spaces. Bytes that are no character count as letters."""
    if not text.isascii():
        chars = text.decode(errors="surrogateescape")
        chars = SIGNS.sub(lambda m: m[0] if _mark(m[0]) or "\udc80" <= m[0] <= "\udcff" else " ", chars)
        chars = SINGLES.sub(lambda m: "".join(c if _mark(c) else f" {c}" for c in m[0]) + " ", chars)
        text = chars.encode(errors="surrogateescape")
    return text.translate(CLEAN)


def token_runs(texts: list[bytes]):
    """As ``word_hashes``, of tokens."""
    return word_hashes([spaced(t) for t in texts])


def _windows(found: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` tokens."""
    n = len(found) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out *= U(BASE)
        out += found[k:n + k]
    return out


class Seeds:
    """The runs of ``width`` tokens of some items: distinct pairs of run and item, and the places
    of each in its item. A run that an item repeats is one pair, however often it does."""

    def __init__(self, tokens: list[np.ndarray], items: np.ndarray, width: int):
        runs = [_windows(tokens[k], width) for k in items.tolist()]
        hashes, item = np.concatenate(runs), np.repeat(items, [len(r) for r in runs])
        place = np.concatenate([np.arange(len(r)) for r in runs]).astype(np.int64)
        order = np.lexsort((place, item, hashes))
        hashes, item, self.place = hashes[order], item[order], place[order]
        first = np.flatnonzero(np.r_[True, (hashes[1:] != hashes[:-1]) | (item[1:] != item[:-1])])
        self.hashes, self.item = hashes[first], item[first]
        self.starts = np.r_[first, len(hashes)]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes >> U(20) & U((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, windows: np.ndarray):
        """Place in ``windows`` and number of the pair of all shared runs."""
        at = np.flatnonzero(self.seen[(windows >> U(20) & U((1 << 22) - 1)).astype(np.int64)])
        low = np.searchsorted(self.hashes, windows[at], side="left")
        n = np.searchsorted(self.hashes, windows[at], side="right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        return np.repeat(at, n), np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())

    def places(self, pairs: np.ndarray) -> np.ndarray:
        """Where in their items some pairs' runs stand."""
        pairs = np.unique(pairs)
        return np.concatenate([self.place[a:b] for a, b in zip(self.starts[pairs].tolist(), self.starts[pairs + 1].tolist())])


@dataclass
class Index:
    """The seeds of one block of the benchmark, by their width: ``seed``, and the lengths of
    items of fewer tokens."""

    ids: list
    tokens: list[np.ndarray]
    seed: int

    def __post_init__(self):
        self.length = np.array([len(t) for t in self.tokens], np.int64)
        width = np.minimum(self.length, self.seed)
        self.seeds = {w: Seeds(self.tokens, np.flatnonzero(width == w), w) for w in np.unique(width).tolist()}


def build_index(rows: list[tuple], seed: int) -> Index:
    """From (item id, text in bytes)."""
    ids, tokens = [], []
    texts = [t or b"" for _, t in rows]
    at = 0
    for found, counts in token_runs(texts):
        ends = np.cumsum(counts)
        for c, e in zip(counts.tolist(), ends.tolist()):
            if c:
                ids.append(rows[at][0])
                tokens.append(found[e - c:e])
            at += 1
    return Index(ids, tokens, seed)


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two runs of tokens: tiles of ``least`` tokens or more as (place in
    the item, place in the text, length). Of matches of one length the earliest in the item and
    then in the text goes first."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    width = max(least, min(len(item), len(text)))
    while width >= least:
        matches = _matches(item, text, free_item, free_text, width)
        longest = max((n for _, _, n in matches), default=0)
        if longest > 2 * width:  # far longer ones go first
            width = longest
            continue
        for n, i, j in sorted((-n, i, j) for i, j, n in matches):
            n = -n
            if free_item[i:i + n].all() and free_text[j:j + n].all():
                free_item[i:i + n] = free_text[j:j + n] = False
                tiles.append((i, j, n))
        if any(not (free_item[i:i + n].all() and free_text[j:j + n].all()) and _left(free_item, free_text, i, j, n, width) for i, j, n in matches):
            continue  # a match was cut by a tile and still is long enough
        width = least if least < width < 2 * least else width // 2
    return tiles


def _left(free_item: np.ndarray, free_text: np.ndarray, i: int, j: int, n: int, width: int) -> bool:
    both = np.r_[False, free_item[i:i + n] & free_text[j:j + n], False]
    edge = np.flatnonzero(np.diff(both.astype(np.int8)))
    return bool(len(edge)) and int((edge[1::2] - edge[::2]).max()) >= width


def _matches(item, text, free_item, free_text, width: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of unmarked tokens, ``width`` long at least."""
    def open_(free):
        return np.convolve(free, np.ones(width, int), "valid") == width if len(free) >= width else np.zeros(0, bool)

    a, b = np.flatnonzero(open_(free_item)), np.flatnonzero(open_(free_text))
    if not len(a) or not len(b):
        return []
    ha, hb = _windows(item, width)[a], _windows(text, width)[b]
    order = np.argsort(ha, kind="stable")
    ha, a = ha[order], a[order]
    low, high = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    n = high - low
    if n.sum() > PAIRS:
        return _diagonals(item, text, free_item, free_text, width)
    row = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    i, j = a[row], np.repeat(b, n)
    # windows that follow each other on one diagonal are one run
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)] if len(i) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(i)]) + width - 1
    return [(x, y, s) for x, y, s in zip(i[first].tolist(), j[first].tolist(), size.tolist())
            if (item[x:x + s] == text[y:y + s]).all()]


def _diagonals(item, text, free_item, free_text, width: int) -> list[tuple[int, int, int]]:
    """``_matches`` where both sides repeat themselves: one token of the item after the other, with
    the lengths of the common runs that end at each token of the text."""
    run, found = np.zeros(len(text) + 1, np.int64), []
    for i in range(len(item) + 1):
        if i < len(item) and free_item[i]:
            goes_on = np.r_[False, (text == item[i]) & free_text]
        else:
            goes_on = np.zeros(len(text) + 1, bool)
        longer = np.zeros(len(text) + 1, np.int64)
        longer[1:][goes_on[1:]] = run[:-1][goes_on[1:]] + 1
        # runs that ended at the token before: the next pair does not go on with them
        over = run >= width
        over[:-1] &= ~goes_on[1:]
        j = np.flatnonzero(over)
        found += zip((i - run[j]).tolist(), (j - run[j]).tolist(), run[j].tolist())
        run = longer
    return found


def leaks(index: Index, texts: list[bytes], coverage: float):
    """(text, item, matched tokens, tiles, longest tile) of every leaked item of each text."""
    if not index.seeds:
        return
    at = 0
    for found, counts in token_runs(texts):
        for width, seeds in index.seeds.items():
            for text, *leak in _leaks(index, seeds, width, found, counts, coverage):
                yield at + text, *leak
        at += len(counts)


def _leaks(index: Index, seeds: Seeds, width: int, found: np.ndarray, counts: np.ndarray, coverage: float):
    """The leaks of items with seeds of one width, in texts that stand one after the other."""
    windows = _windows(found, width)
    if not len(windows):
        return
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    windows = np.where(np.arange(len(windows)) + width <= ends[owner[:len(windows)]], windows, U(0))
    place, pair = seeds.hits(windows)
    place, pair = (x[place + width <= ends[owner[place]]] for x in (place, pair))
    item = seeds.item[pair]
    order = np.lexsort((place, item, owner[place]))
    place, item, pair = place[order], item[order], pair[order]
    new = np.flatnonzero(np.r_[True, (np.diff(owner[place]) != 0) | (np.diff(item) != 0)]) if len(place) else []
    for a, b in zip(new, [*new[1:], len(place)]):
        k = int(item[a])
        under = np.zeros(int(index.length[k]), bool)
        if len(under) == width:  # the item as a whole: its first place tells
            b = a + 1
        where = seeds.places(pair[a:b])
        for s in range(width):
            under[where + s] = True
        if under.sum() < coverage * len(under):
            continue
        # only tokens under seeds can be tiled; a gap stands for what lies between
        spots = np.unique((place[a:b, None] + np.arange(width)).ravel())
        gap = np.flatnonzero(np.diff(spots) > 1) + 1
        part = np.insert(found[spots], gap, np.arange(len(gap), dtype=np.uint64))
        tiles = tile(index.tokens[k], part, width)
        matched = sum(n for _, _, n in tiles)
        if matched >= coverage * len(under):
            yield int(owner[place[a]]), k, matched, len(tiles), max(n for _, _, n in tiles)


_TOLD: dict[str, Index] = {}  # of a Python worker


def _told(path: str) -> Index:
    """A block's index, from its file. A worker keeps the last one it has read."""
    if path not in _TOLD:
        store, inner = fs.FileSystem.from_uri(path)
        with store.open_input_stream(inner) as f:
            rows, seed = pickle.loads(f.read())
        _TOLD.clear()
        _TOLD[path] = build_index(rows, seed)
    return _TOLD[path]


def index_files(bench: DataFrame, item_id: str, text: str, seed: int, block_bytes: int | None = None) -> tuple[list[str], DataFrame]:
    """The benchmark's distinct texts in files of at most ``block_bytes`` (or one longer text),
    written by tasks, and the stored items: id and text's digest. The paths come to the driver, one
    for each file."""
    spark = bench.sparkSession
    folder, block_bytes = new_path(spark, "benchmark"), block_bytes or BLOCK_BYTES
    rows = bench.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    items = materialise(rows.select("item_id", F.sha2("t", 256).alias("digest")), "benchmark_items")
    texts = rows.select(F.sha2("t", 256).alias("digest"), "t").groupBy("digest").agg(F.first("t").alias("t"))

    def run(batches):
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)
        held, size = [], 0

        def written():
            name = f"{uuid.uuid4().hex}.block"
            with store.open_output_stream(f"{inner}/{name}") as out:
                out.write(pickle.dumps((held, seed)))
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": pa.array([size], pa.int64())})

        for b in batches:
            for digest, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if held and size + len(t) > block_bytes:
                    yield written()
                    held, size = [], 0
                held.append((digest, t))
                size += len(t)
        if held:
            yield written()

    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    # a few blocks' texts to a task, in an order that does not hang on the run
    tasks = 1 + total // (4 * block_bytes)
    manifest = materialise(texts.repartition(tasks, "digest").sortWithinPartitions("digest").mapInArrow(run, "path string, bytes long"), "benchmark_blocks")
    return sorted(r.path for r in manifest.select("path").collect()), items


def _held(batches, column: int, blocks: int):
    """Batches that meet the blocks together: one by one if there is one block, else some
    ``HELD_BYTES`` of text, so that blocks are read once for each."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes
        if blocks <= 1 or size >= HELD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_leaks(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               seed: int = SEED, coverage: float = COVERAGE, block_bytes: int | None = None) -> DataFrame:
    """One row for each document and item that leaked into it."""
    paths, items = index_files(bench, item_id, "text", seed, block_bytes)
    given = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    schema = LEAK.replace("item_id long", "digest string")
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches):
        for held in _held(batches, 1, len(paths)):
            for path in paths:
                own = _told(path)
                for b in held:
                    ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                    rows = [(ids[i], own.ids[k], len(own.tokens[k]), m, m / len(own.tokens[k]), n, longest) for i, k, m, n, longest in leaks(own, texts, coverage)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in schema.split(", ")])

    # items of one text leak together
    return given.mapInArrow(run, schema).join(items, "digest").select(*[f.split()[0] for f in LEAK.split(", ")])


def keep_unleaked(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id",
                  seed: int = SEED, coverage: float = COVERAGE, block_bytes: int | None = None) -> DataFrame:
    """The documents that hold no leaked item."""
    paths, _ = index_files(bench, item_id, "text", seed, block_bytes)
    names = docs.columns

    def run(batches):
        for held in _held(batches, names.index(text), len(paths)):
            good = [np.ones(b.num_rows, bool) for b in held]
            for path in paths:
                own = _told(path)
                for b, kept in zip(held, good):
                    texts = [t or b"" for t in b.column(names.index(text)).cast(pa.binary()).to_pylist()]
                    for i, *_ in leaks(own, texts, coverage):
                        kept[i] = False
            for b, kept in zip(held, good):
                yield b.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
