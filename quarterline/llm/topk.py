"""Exact top-k search by inner product, by MaxScore in shards.

A vector's components are terms: one for each dimension and sign, with the component's size as
its weight in the posting list. A query meets, for each dimension, the term of its own sign,
whose products are positive; the other sign only lowers a score. A first k-th best score comes from
the heads of the query's strongest lists, a few rows each. Postings are then passed in blocks of
rows, those first whose bounds promise most, until a block's bounds stay below the k-th best. For
each block terms are split anew by their score bounds in it: what the smallest of them can add
together stays below the k-th best score so far, so a row needs the essential rest. Essential
postings are added up first; rows whose sum and what the others could still add reach the k-th best
are probed, on the essential dimensions' other sign and then on the others, and those that stay
competitive raise the k-th best for the next block. Equal scores go to the smaller id, so a bound
that equals the k-th best is still looked at.

Rows are dealt into shards by a hash of their ids, a shard is one task's index of bounded size,
and the queries pass by it in blocks. Each shard's k best are merged by a window that keeps k of
each query before it shuffles. A stated query set is compared with all rows, in blocks; there is
no join of rows with rows.

Vectors that are null or hold a null or non-finite component take no part; a null id neither.
Shorter vectors count as if zeros followed. A query's own id is no candidate; repeated rows of
another id are candidates each. A query id that comes with several vectors is asked with the
smallest of them. A score beyond 64 bits ends the job with an error. Other columns are not read.
An empty table gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 100_000
QUERY_BLOCK = 256
BLOCK_ROWS = 1024
HEADS, LEADERS = 16, 4  # rows at the head of a list, lists whose heads give the first k-th best
EXACT = 1 << 53


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of all components, null where the vector takes no part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(fine, scaled)


class Shard:
    """Posting lists of one shard, by dimension and sign, their heads, and their score bounds by
    block of rows. ``probed`` and ``passed`` count pairs of query and row whose scores were finished,
    and all."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int = 5):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.dims, n = rows.shape[1], len(ids)
        self.postings = np.concatenate([np.maximum(self.rows, 0).T, np.maximum(-self.rows, 0).T])
        self.starts = np.arange(0, n, BLOCK_ROWS)
        self.bounds = np.maximum.reduceat(self.postings, self.starts, axis=1) if n and self.dims else np.zeros((2 * self.dims, len(self.starts)), rows.dtype)
        # one more than k, as the query's own row may be among them
        self.heads = np.argsort(-self.postings, axis=1, kind="stable")[:, :max(HEADS, k + 1)]
        self.probed = self.passed = 0

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """For each query, a row of ``queries``, (score, id) of the k best rows, the best first."""
        self.passed += len(queries) * len(self.ids)
        # a query's weights on the terms of its own sign, and on the others, which lower a score
        same = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], 1)
        other = np.roll(same, self.dims, 1)
        strongest = np.argsort(-(same * self.bounds.max(1, initial=0)), axis=1, kind="stable")[:, :LEADERS]
        best, led = [], []
        for q, terms in enumerate(strongest):
            rows = np.unique(self.heads[terms])
            led.append(rows)
            best.append(self._better([], rows, self.rows[rows] @ queries[q], own[q], k))
            self.probed += len(rows)
        promise = same @ self.bounds
        for block in np.argsort(-promise.max(0, initial=0), kind="stable").tolist():
            at = slice(int(self.starts[block]), min(int(self.starts[block]) + BLOCK_ROWS, len(self.ids)))
            open_ = [q for q in range(len(queries)) if len(best[q]) < k or promise[q, block] >= best[q][-1][0]]
            if not open_:
                continue
            least = np.array([best[q][-1][0] if len(best[q]) == k else -np.inf for q in open_], dtype=same.dtype)
            for q, rows, scores in self._competitive(at, block, least, same[open_], other[open_]):
                q = open_[q]
                fresh = ~np.isin(rows, led[q])
                best[q] = self._better(best[q], rows[fresh], scores[fresh], own[q], k)
        return [[(score, i) for score, i in found] for found in best]

    def _competitive(self, at: slice, block: int, least: np.ndarray, same: np.ndarray, other: np.ndarray):
        """For each query with such rows, its place, the block's rows that reach ``least``, and their scores.
        A spare term is one of the query's own sign; its dimension's other sign is left for the end as well."""
        bound = same * self.bounds[:, block]
        order = np.argsort(bound, axis=1, kind="stable")
        spare = np.zeros(bound.shape, bool)
        np.put_along_axis(spare, order, np.cumsum(np.take_along_axis(bound, order, 1), 1) < least[:, None], 1)
        spare &= same > 0
        more = np.where(spare, bound, 0).sum(1)
        postings = self.postings[:, at]
        total = np.where(spare, 0, same) @ postings
        alive = total + more[:, None] >= least[:, None]
        late = np.roll(spare, self.dims, 1)  # the other signs of the spare terms' dimensions
        _add(total, alive, np.where(late, 0, -other), postings)
        alive &= total + more[:, None] >= least[:, None]
        self.probed += int(np.count_nonzero(alive))
        _add(total, alive, np.where(spare, same, 0) - np.where(late, other, 0), postings)
        alive &= total >= least[:, None]
        for q in np.flatnonzero(alive.any(1)).tolist():
            rows = np.flatnonzero(alive[q])
            yield q, rows + at.start, total[q, rows]

    def _better(self, best, rows, scores, own, k):
        ids = self.ids[rows]
        keep = ids != own
        ids, scores = ids[keep], scores[keep]
        if len(ids) > k:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= cut], scores[scores >= cut]
        found = best + list(zip([int(s) for s in scores], ids.tolist()))
        return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def _add(total: np.ndarray, alive: np.ndarray, weights: np.ndarray, postings: np.ndarray) -> None:
    """Add the postings of some weights to the sums of pairs that are alive; where most are, to all
    of their queries'."""
    if np.count_nonzero(alive) * 8 > alive.size:
        some = np.flatnonzero(alive.any(1))
        total[some] += weights[some] @ postings
        return
    q, r = np.nonzero(alive)
    for a in range(0, len(q), BLOCK_ROWS):
        part = slice(a, a + BLOCK_ROWS)
        total[q[part], r[part]] += (weights[q[part]] * postings[:, r[part]].T).sum(1)


def _matrix(parts: list[tuple[np.ndarray, np.ndarray]], dims: int) -> np.ndarray:
    """Rows of ``dims`` components from (components one after the other, lengths)."""
    lengths = np.concatenate([n for _, n in parts])
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = np.concatenate([v for v, _ in parts])
    return out


def _typed(rows: np.ndarray, top: int, other: int) -> np.ndarray:
    """As doubles where all sums stay exact, else as Python's integers."""
    return rows.astype(np.float64) if top * other * max(rows.shape[1], 1) < EXACT else rows.astype(object)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if len(values) else 0


def _segments(batch: pa.RecordBatch):
    """Stretches of one shard and kind: shard, kind, ids, components, lengths."""
    shard, kind, ids = (batch.column(i).to_numpy() for i in range(3))
    vectors = batch.column(3)
    lengths, values = vectors.value_lengths().to_numpy(), vectors.flatten().to_numpy()
    ends = np.r_[0, np.cumsum(lengths)]
    cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])]) if len(ids) else []
    for a, b in zip(cut, [*cut[1:], len(ids)]):
        yield int(shard[a]), int(kind[a]), ids[a:b], values[ends[a]:ends[b]], lengths[a:b]


def _search_shards(given: DataFrame, k: int, shards: int) -> DataFrame:
    """``given``: shard, query flag, id and vector; a shard's rows before its queries."""
    def answers(index, ids, values, lengths):
        rows, tops = index
        ends = np.r_[0, np.cumsum(lengths)]
        kinds: dict[np.dtype, list[int]] = {}
        for n in range(len(ids)):
            kinds.setdefault(_typed(rows[1][:1], tops, _largest(values[ends[n]:ends[n + 1]])).dtype, []).append(n)
        out = []
        for kind, chosen in kinds.items():
            shard = rows[2].setdefault(kind, None) or Shard(rows[0], rows[1].astype(kind), k)
            rows[2][kind] = shard
            whole = np.zeros((len(chosen), rows[1].shape[1]), kind)
            for m, n in enumerate(chosen):
                query = values[ends[n]:ends[n + 1]][:whole.shape[1]]
                whole[m, :len(query)] = query
            own = ids[chosen]
            out += [(i, j, s) for i, found in zip(own.tolist(), shard.search(own, whole, k)) for s, j in found]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"]) if out else None

    def run(batches):
        shard, ids, parts, index = None, [], [], None
        for b in batches:
            for s, is_query, own, values, lengths in _segments(b):
                if s != shard:
                    shard, ids, parts, index = s, [], [], None
                if not is_query:
                    ids.append(own)
                    parts.append((values, lengths))
                    continue
                if not ids:
                    continue
                if index is None:
                    dims = max(int(n.max()) for _, n in parts)
                    index = (np.concatenate(ids), _matrix(parts, dims), {}), max(_largest(v) for v, _ in parts)
                    parts = []
                at = 0
                while at < len(own):
                    end = at + QUERY_BLOCK
                    ends = np.r_[0, np.cumsum(lengths)]
                    if (found := answers(index, own[at:end], values[ends[at]:ends[min(end, len(own))]], lengths[at:end])) is not None:
                        yield found
                    at = end

    return given.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "is_query").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, vec_id: str, vector: str, is_query: Column, k: int = 5, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: for each row that ``is_query`` marks, the
    k rows with the largest inner product."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), whole_numbers(F.col(vector), scale).alias("v"), is_query.alias("asks"))
    rows = rows.where("id IS NOT NULL AND v IS NOT NULL")
    shards = max(-(-rows.count() // shard_rows), vectors.sparkSession.sparkContext.defaultParallelism)
    data = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), F.lit(0).alias("is_query"), "id", "v")
    queries = rows.where("asks").groupBy("id").agg(F.min("v").alias("v")).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("is_query"), "id", "v")
    found = _search_shards(data.unionByName(queries), k, shards)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
