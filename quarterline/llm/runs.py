"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal)
that is at least ``exponent`` periods and ``least`` words long and that no neighbouring word
extends. A run of period ``q`` holds a position that is a multiple of ``(exponent - 1) * q``
together with the one ``q`` further. These positions of all periods, the harmonic grid, are n log n;
where the two words are equal, two longest common extensions on the run-length grammar of the
words (``recompression``), one to each side, give the run exactly. Of stretches found with several
periods the smallest counts.

Words are runs of bytes other than 0x20 and 0x09 to 0x0D, numbered from 0 and compared whole.
Documents of a batch share one grammar, with separators that occur once, so no run crosses them.
Every text is on its own: nothing is shuffled, a group of copies or a hot source costs its rows,
and a lost executor's tasks are run again. Memory: a batch of ``BATCH_WORDS`` words, or the one text
that is longer, some 200 bytes a word.

Null, empty and blank texts have no runs and an empty collapsed text; a null id is carried as it
is. Repeated rows give repeated rows. Very long texts are read whole. Other columns, whatever
their names, are not touched. An empty table gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.recompression import extensions, grammar

BATCH_WORDS = 1 << 18
QUERIES = 1 << 19  # extensions asked for at once
RUN = "start: bigint, length: bigint, period: bigint"
SPACES = r"[\x20\x09-\x0D]+"


class Numbers(dict):
    """Words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def find_runs(sequence: np.ndarray, longest: int, exponent: int = 4, least: int = 6) -> np.ndarray:
    """Rows of start, length and period, by start and period, of a sequence of numbers from 0
    whose first and last symbol occur once. Stretches between symbols that occur once are at
    most ``longest`` long."""
    n = len(sequence)
    levels = grammar(sequence)
    back = [level.mirrored() for level in levels]
    found, waiting, held = [], [], 0

    def extend() -> None:
        x = np.concatenate([w[0] for w in waiting])
        p = np.repeat([w[1] for w in waiting], [len(w[0]) for w in waiting])
        before = extensions(back, n - x, n - x - p)
        length = before + p + extensions(levels, x, x + p)
        ok = length >= np.maximum(least, exponent * p)
        found.append(np.stack([x - before, length, p], 1)[ok])

    for p in range(1, longest // exponent + 1):
        step = (exponent - 1) * p
        x = np.flatnonzero(sequence[:n - p:step] == sequence[p::step])
        if len(x):
            waiting.append((x * step, p))
            held += len(x)
            if held >= QUERIES:
                extend()
                waiting, held = [], 0
    if waiting:
        extend()
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs_of_texts(texts: list[bytes], exponent: int = 4, least: int = 6):
    """For each text its runs, as rows of start, length and period, and the text collapsed."""
    numbers, parts, words = Numbers(), [], [t.split() for t in texts]
    own = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    apart = len(numbers)
    for k, ids in enumerate(own):
        parts += [[apart + k], ids]
    sequence = np.concatenate([*parts, [apart + len(own)]]).astype(np.int64)
    sizes = np.array([len(w) for w in words])
    starts = np.cumsum(np.r_[0, sizes[:-1] + 1]) + 1
    rows = find_runs(sequence, int(sizes.max(initial=0)), exponent, least)
    cover = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(cover, rows[:, 0] + rows[:, 2], 1)
    np.add.at(cover, rows[:, 0] + rows[:, 1], -1)
    kept = np.cumsum(cover) == 0
    bounds = np.searchsorted(rows[:, 0], np.r_[starts, len(sequence)])
    for k, w in enumerate(words):
        mine = rows[bounds[k]:bounds[k + 1]] - [starts[k], 0, 0]
        if len(mine):
            w = [w[i] for i in np.flatnonzero(kept[starts[k]:starts[k] + len(w)]).tolist()]
        yield mine, b" ".join(w)


def periodic_runs(df: DataFrame, id: str, text: str, exponent: int = 4, least: int = 6) -> DataFrame:
    """``id`` as it is named, ``runs`` (array of start, length, period, by start and period) and
    ``collapsed``: the words that no run holds after its first period, joined by one space."""
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    typed = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches):
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, size = at + 1, len(texts[at])
                while end < len(texts) and size + len(texts[end]) <= 6 * BATCH_WORDS:
                    size += len(texts[end])
                    end += 1
                rows, collapsed = zip(*runs_of_texts(texts[at:end], exponent, least))
                flat = np.concatenate(rows)
                ends = np.cumsum([0, *map(len, rows)])
                values = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int64()) for c in range(3)], fields=list(typed.value_type))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, end - at), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=typed),
                     pa.array([c.decode() for c in collapsed], pa.string())], ["id", "runs", "collapsed"])
                at = end

    kind = dict(df.dtypes)[id]
    found = df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, runs array<struct<{RUN}>>, collapsed string")
    return found.withColumnRenamed("id", id)


def strongest(runs: Column) -> Column:
    """The run of greatest exact length/period; of equals the first by start, then period."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, 0),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def listing(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")


def varied(df: DataFrame, id: str, text: str) -> DataFrame:
    """``id`` and ``text`` as the query asks about them. With h the crc32 of the id in decimals and
    g = h div 10: if h mod 10 is 0 and there are n > 0 words, each word i >= a is the original word
    a + (i - a) mod p, with a = g mod n and p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    split = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), lambda w: w != "")
    # a column of its own, or the text is split again for each word
    df = df.select(F.col(id), F.col(text), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    n = F.size("words")
    df = df.select(id, text, "words", n.alias("n"), (F.col("g") % n).cast("int").alias("a"), (3 + F.col("g") % 8).alias("of"))
    df = df.select(id, text, "words", "n", "a", (1 + F.floor((F.col("n") - F.col("a")) / F.col("of"))).cast("int").alias("p"))
    a, p = F.col("a"), F.col("p")
    again = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p))), " ")
    return df.select(id, F.when(F.col("n") > 0, again).otherwise(F.col(text)).alias(text))
