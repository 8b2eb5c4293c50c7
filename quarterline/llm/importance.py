"""Importance resampling towards a target distribution of hashed n-grams.

Each text is a bag of its runs of 1 to 2 words, and each n-gram falls into one of ``BUCKETS`` buckets
by its crc32. A bucket's gain is the logarithm of its smoothed share in the target over that in the
source; a text's weight is the mean gain of its n-grams, and noise of Gumbel's distribution, fixed by
the id, makes taking the highest scores a draw without replacement.

The documents are read twice, for the source's counts and for the weights. Both times the n-grams of
a batch go through the table of ``interning``: counts are added by entry, so a task sends at most
``BUCKETS`` rows however often an n-gram occurs, and gains are fetched by the occurrences' entry
numbers. Source and target counts are ``BUCKETS`` rows at most, and so are the gains each task gets.

Ranks need no sort of all rows: scores are whole numbers, and gains and noise are bounded by the
logarithms of the counts and of 2^33, so a table of documents by score has some ten thousands of
rows whatever the corpus. Only documents at or above the score that reaches the quota are ordered,
within their score. A copy's score is its own, as ids differ.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Null texts have none;
texts without words weigh 0. A null id draws the noise of an empty one and comes after others of its
score. Equal scores go by id, then by number of n-grams; repeated rows are drawn each for itself. Very
long texts are taken whole, in slices cut between words. Other columns, whatever their names, are not
touched. An empty corpus gives no rows, an empty target has no counts.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.interning import Spans, Table
from quarterline.plans.lineage import materialise

BUCKETS = 10_000
BATCH_BYTES = 1 << 21
FLAT = 4294967296  # 2^32

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Batch:
    """Words and n-grams of some texts, or of a slice of one."""

    def __init__(self, texts: list[bytes], width: int, carried: int = 0):
        """``carried``: words at the start that an earlier slice has counted."""
        data = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
        word = WORD[data]
        edge = np.flatnonzero(np.diff(np.r_[False, word].astype(np.int8)))
        start, end = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, start, side="right")
        # one space after each word, nothing else between them
        word[end] = True
        data[end] = 0x20
        data, length = data[word], end - start
        at = np.cumsum(np.r_[0, length[:-1] + 1]) if len(length) else length
        starts, lengths, owners = [], [], []
        for k in range(width):
            n = len(length) - k
            if n <= 0:
                break
            first = np.flatnonzero((owner[:n] == owner[k:]) & (np.arange(n) + k >= carried))
            starts.append(at[first])
            lengths.append(at[first + k] + length[first + k] - at[first])
            owners.append(owner[first])
        empty = np.empty(0, np.int64)
        self.words = np.bincount(owner[carried:], minlength=len(texts))
        self.owner = np.concatenate(owners or [empty])
        self.spans = Spans(data, np.concatenate(starts or [empty]), np.concatenate(lengths or [empty]))
        self.table = Table(self.spans, BUCKETS)

    def counts(self) -> np.ndarray:
        t = self.table
        return np.bincount(t.bucket, weights=t.count, minlength=BUCKETS).astype(np.int64)


def _slices(text: bytes, width: int):
    """A long text in slices, each with the last words of the one before, and their number."""
    at, before = 0, []
    while at < len(text):
        end = min(at + BATCH_BYTES, len(text))
        while end < len(text) and WORD[LOWER[text[end]]]:
            end += 1
        part = text[at:end]
        yield b" ".join([*before, part]), len(before)
        if width > 1:
            # the last words, from a tail that grows until it holds them
            size, words = 256, []
            while True:
                tail = part[-size:]
                mask = np.r_[False, WORD[LOWER[np.frombuffer(tail, np.uint8)]], False]
                edge = np.flatnonzero(np.diff(mask.astype(np.int8)))
                words = [tail[a:b] for a, b in zip(edge[::2], edge[1::2])]
                if len(words) >= width or size >= len(part):
                    break
                size *= 4
            before = [*before, *words][-(width - 1):]
        at = end


def batches_of(texts: list[bytes], width: int):
    """Runs of texts as batches with their numbers; slices of a long text come one by one."""
    at = 0
    while at < len(texts):
        if len(texts[at]) > BATCH_BYTES:
            for part, carried in _slices(texts[at], width):
                yield range(at, at + 1), Batch([part], width, carried)
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) <= BATCH_BYTES:
            size += len(texts[end])
            end += 1
        yield range(at, end), Batch(texts[at:end], width)
        at = end


def bucket_counts(df: DataFrame, text: str, width: int = 2) -> DataFrame:
    """``bucket`` and ``n``: how many n-grams of all texts fall into each bucket."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for _, batch in batches_of([(t or "").encode() for t in b.column(0).to_pylist()], width):
                total += batch.counts()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return df.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket, in whole thousandths; from at most ``BUCKETS`` rows of either."""
    dense = []
    for counted in (source, target):
        n = np.zeros(BUCKETS, np.int64)
        for row in counted.collect():
            n[row.bucket] = row.n
        dense.append(n.tolist())
    s_all, t_all = (float(sum(n) + BUCKETS) for n in dense)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(*dense)], np.int64)


def weigh(df: DataFrame, id: str, text: str, gain: np.ndarray, width: int = 2) -> DataFrame:
    """``id`` as it is named, ``n_words``, ``n_features`` and ``weight`` of each text."""
    told = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            words, features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for rows, batch in batches_of(texts, width):
                n = len(rows)
                per_slot = told.value[batch.table.bucket]
                words[rows.start:rows.stop] += batch.words
                features[rows.start:rows.stop] += np.bincount(batch.owner, minlength=n)
                # sums of whole numbers below 2^53
                total[rows.start:rows.stop] += np.bincount(batch.owner, weights=per_slot[batch.table.slots], minlength=n).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(features), pa.array(weight)], ["id", "n_words", "n_features", "weight"])

    kind = dict(df.dtypes)[id]
    found = df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")
    return found.withColumnRenamed("id", id)


def noise(id: Column, seed: int) -> Column:
    """Gumbel noise in whole thousandths from the first 32 bits of sha256 of ``seed:id``."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / FLAT)))


def draw(scored: DataFrame, id: str, eligible: Column, percent: int) -> DataFrame:
    """Add ``rank``: 1, 2, 3 ... by falling ``score`` for the highest ``percent`` of the eligible
    rows, null for all others."""
    counted = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    down = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy()
    cut = (
        counted.select("score", F.coalesce(F.sum("n").over(down), F.lit(0)).alias("above"), F.floor(percent * F.sum("n").over(all_) / 100).alias("quota"))
        .where(F.col("above") < F.col("quota"))
    )
    inside = Window.partitionBy("score").orderBy(F.asc_nulls_last(id), "n_features")
    near = scored.where(eligible).join(F.broadcast(cut), "score")  # one row a score, see above
    place = F.col("above") + F.row_number().over(inside)
    ranked = near.select(*scored.columns, F.when(place <= F.col("quota"), place).alias("rank"))
    rest = scored.join(F.broadcast(cut.select("score", F.lit(True).alias("reached"))), "score", "left")
    rest = rest.where(~eligible | F.col("reached").isNull()).select(*scored.columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = 25, least_words: int = 20, seed: int = 7) -> DataFrame:
    """``id`` as it is named, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of
    every document; ranks are given to the drawn ones, ``percent`` of those of ``least_words``."""
    gain = gains(bucket_counts(docs, text), bucket_counts(target, target_text))
    weighed = weigh(docs, id, text, gain).withColumn("score", F.col("weight") + noise(F.col(id), seed))
    return draw(materialise(weighed, "weighed"), id, F.col("n_words") >= least_words, percent)
