"""Toxic spans by a linear-chain conditional random field, summed up to document scores.

Fitting takes a bounded sample of labelled rows (``FIT_ROWS`` of each label, the first by a hash
of the id, texts of up to ``FIT_CHARS`` characters). Labels of documents become labels of tokens
by the words and word beginnings that stand in significantly more contexts (pairs of words
before and after) of toxic documents; copies of a document add no context. A field
with the states "toxic" and "other" is fitted to the tagged sentences; its features are a
token's word and first 4, 5 and 6 bytes. A document's score is a logistic function of the sum
and the maximum of its tokens' forward-backward marginals, fitted to the sample weighted by the
counts of all labels.

Scoring is one narrow pass over whole texts with the model broadcast, whose size is bounded by
the sample. A token is a run of letters, A-Z in lower case; a chain is a sentence, however long: one of
over ``CHAIN`` tokens is passed in blocks of so many at a time, whose messages are products of their
moves and are handed on from block to block, which changes no marginal. A run of over ``SLICE`` bytes
of letters counts as several tokens.

Nulls and empty texts get the score of a text without evidence. Without a toxic label among the
rows to learn from all scores are 0, without a clean one they are the share of toxic labels.
Null labels are not learned from. Repeated rows score alike. Very long texts are read whole.
Other columns are never inputs. An empty table gives no rows.
"""
from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm.words import BYTES, INVERSE, POWER, SLICE, U, mix

FIT_ROWS = 1500
FIT_CHARS = 20_000
LEAST = 5  # contexts of a feature
MARKED = 30  # likelihood ratio from which a feature marks tokens
CHAIN = 256  # tokens passed one by one; longer chains go in blocks of them
STEPS, RATE = 40, 0.3
PREFIXES = (4, 5, 6)
CERTAIN = 0.3  # marginals below it don't add up, however long a text is

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of features
    weights: np.ndarray
    bias: float
    moves: np.ndarray  # 2 x 2, in logarithms; state 1 is toxic
    document: np.ndarray  # weights of _document_features
    constant: float | None = None

    def __post_init__(self):
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys & U((1 << 20) - 1)).astype(np.int64)] = True

    def emission(self, features: np.ndarray) -> np.ndarray:
        score = np.full(len(features), self.bias)
        if not len(self.keys):
            return score
        for k in range(features.shape[1]):
            own = features[:, k]
            rows = np.flatnonzero(self.seen[(own & U((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, own[rows]), len(self.keys) - 1)
            score[rows] += np.where(self.keys[at] == own[rows], self.weights[at], 0.0)
        return score


def tokens(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, features and sentence breaks before each of the tokens of at most ``SLICE`` bytes."""
    letter = LETTER[data]
    edge = np.flatnonzero(np.diff(np.r_[False, letter, False].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(BYTES[data] * POWER[:len(data)], out=total[1:])
    features = np.empty((len(start), 1 + len(PREFIXES)), np.uint64)
    features[:, 0] = mix((total[end] - total[start]) * INVERSE[start] + U(1))
    for k, n in enumerate(PREFIXES, 1):
        cut = np.minimum(start + n, end)  # a shorter word is its own beginning
        features[:, k] = mix((total[cut] - total[start]) * INVERSE[start] + U(n))
    return start, end, features, np.r_[0, np.cumsum(BREAK[data])][start]


def chains(breaks: np.ndarray) -> np.ndarray:
    """Chain numbers of tokens: those with as many breaks before them are one."""
    return np.cumsum(np.r_[True, breaks[1:] != breaks[:-1]][:len(breaks)]) - 1


def _normal(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors or matrices by their sums, and the sums' logarithms."""
    total = x.reshape(len(x), -1).sum(1)
    return x / total.reshape(-1, *[1] * (x.ndim - 1)), np.log(total)


def _long(emission: np.ndarray, moves: np.ndarray, pairs: np.ndarray | None):
    """``marginals`` of one chain, in blocks."""
    n, step = len(emission), np.exp(moves)
    blocks = -(-n // CHAIN)
    weight = np.ones(blocks * CHAIN)
    weight[:n] = np.exp(np.clip(emission, -30, 30))
    weight = weight.reshape(blocks, CHAIN)
    there = (np.arange(blocks * CHAIN) < n).reshape(blocks, CHAIN)

    def move(t: int) -> np.ndarray:
        """Each block's matrix at its t-th token; none beyond the end and before the first."""
        m = np.where(there[:, t, None, None], step, np.eye(2))
        if t == 0:
            m[0] = np.eye(2)
        m = m.copy()
        m[:, :, 1] *= np.where(there[:, t], weight[:, t], 1.0)[:, None]
        return m

    every = [move(t) for t in range(CHAIN)]
    product, size = _normal(every[0])
    for m in every[1:]:
        product, more = _normal(product @ m)
        size += more
    before, after = np.ones((blocks, 2)), np.ones((blocks, 2))
    logz = float(size.sum())
    for k in range(1, blocks + 1):
        ahead = before[k - 1] @ product[k - 1]
        logz += math.log(ahead.sum())
        if k < blocks:
            before[k] = ahead / ahead.sum()
    for k in range(blocks - 1, 0, -1):
        behind = product[k] @ after[k]
        after[k - 1] = behind / behind.sum()
    alpha = np.empty((CHAIN + 1, blocks, 2))
    alpha[0] = before
    for t, m in enumerate(every):
        alpha[t + 1] = _normal((alpha[t][:, None] @ m)[:, 0])[0]
    beta, out = after, np.empty((blocks, CHAIN))
    for t in range(CHAIN - 1, -1, -1):
        p = alpha[t + 1] * beta
        out[:, t] = p[:, 1] / p.sum(1)
        if pairs is not None:
            joint = alpha[t][:, :, None] * every[t] * beta[:, None]
            joint /= joint.sum((1, 2), keepdims=True)
            moved = there[:, t].copy()
            moved[0] &= t > 0
            pairs += joint[moved].sum(0)
        beta = _normal((every[t] @ beta[:, :, None])[:, :, 0])[0]
    return out.ravel()[:n], logz


def marginals(emission: np.ndarray, chain: np.ndarray, moves: np.ndarray, pairs: np.ndarray | None = None):
    """Each token's probability of the toxic state. ``pairs``, 2 x 2, gathers the expected
    numbers of moves; the logarithm of all chains' partition functions comes second."""
    out = np.zeros(len(emission))
    if not len(emission):
        return out, 0.0
    first = np.flatnonzero(np.r_[True, chain[1:] != chain[:-1]])
    length = np.diff(np.r_[first, len(chain)])
    step = np.exp(moves)
    logz = 0.0
    for k in np.flatnonzero(length > CHAIN).tolist():
        at = slice(int(first[k]), int(first[k] + length[k]))
        out[at], more = _long(emission[at], moves, pairs)
        logz += more
    first, length = first[length <= CHAIN], length[length <= CHAIN]
    size = np.ceil(np.log2(length)).astype(int)
    for s in np.unique(size):
        own = np.flatnonzero(size == s)
        own = own[np.argsort(-length[own], kind="stable")]
        n, most = len(own), int(length[own].max())
        active = np.searchsorted(-length[own], -np.arange(most), side="left")  # chains longer than t
        place = first[own]
        weight = np.exp(np.clip(emission, -30, 30))
        alpha = np.empty((most, n, 2))
        scale = np.empty((most, n))
        for t in range(most):
            m = active[t]
            w = weight[place[:m] + t]
            a = alpha[t, :m]
            if t:
                before = alpha[t - 1, :m]
                a[:, 0] = before[:, 0] * step[0, 0] + before[:, 1] * step[1, 0]
                a[:, 1] = (before[:, 0] * step[0, 1] + before[:, 1] * step[1, 1]) * w
            else:
                a[:, 0], a[:, 1] = 1.0, w
            c = scale[t, :m]
            np.add(a[:, 0], a[:, 1], out=c)
            a /= c[:, None]
            logz += float(np.log(c).sum())
        beta = np.ones((n, 2))
        for t in range(most - 1, -1, -1):
            m = active[t]
            p = alpha[t, :m] * beta[:m]
            z = p.sum(1)
            out[place[:m] + t] = p[:, 1] / z
            if t:
                w = weight[place[:m] + t]
                b0, b1 = beta[:m, 0] / scale[t, :m], beta[:m, 1] * w / scale[t, :m]
                if pairs is not None:
                    before = alpha[t - 1, :m]
                    for i in (0, 1):
                        pairs[i, 0] += (before[:, i] * step[i, 0] * b0 / z).sum()
                        pairs[i, 1] += (before[:, i] * step[i, 1] * b1 / z).sum()
                beta[:m, 0], beta[:m, 1] = step[0, 0] * b0 + step[0, 1] * b1, step[1, 0] * b0 + step[1, 1] * b1
    return out, logz


def _pieces(texts: list[bytes]):
    """Runs of whole texts of up to ``SLICE`` bytes, or one longer text in slices: first text, the
    starts of the texts in the run, and slices with their places."""
    at = 0
    while at < len(texts):
        if len(texts[at]) >= SLICE:
            data, cut, slices = np.frombuffer(texts[at], np.uint8), 0, []
            while cut < len(data):
                end = min(cut + SLICE, len(data))
                gaps = np.flatnonzero(~LETTER[data[cut:end]]) if end < len(data) else []
                end = cut + int(gaps[-1]) + 1 if len(gaps) else end
                slices.append((cut, data[cut:end]))
                cut = end
            yield at, np.array([0]), slices
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) < SLICE:
            size += len(texts[end]) + 1
            end += 1
        yield at, np.cumsum([0, *(len(t) + 1 for t in texts[at:end - 1])]), [(0, np.frombuffer(b"\n".join(texts[at:end]), np.uint8))]
        at = end


def _tokens_of(slices, of_features):
    """Starts, ends, what ``of_features`` makes of the features, and chains of a run's tokens."""
    parts, breaks = [], 0
    for shift, data in slices:
        start, end, features, before = tokens(data)
        parts.append((start + shift, end + shift, of_features(features), before + breaks))
        breaks += int(BREAK[data].sum())
    start, end, made, before = (np.concatenate(x) for x in zip(*parts))
    return start, end, made, chains(before)


def _document_features(total: np.ndarray, most: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of the sum of the marginals that reach ``CERTAIN``, their maximum and the tokens' number."""
    share = 100 * total / np.maximum(size, 200)
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(share), most, most ** 8], 1)


def score(model: Model, texts: list[bytes], least: float | None = None):
    """Scores of texts and, with ``least``, the tokens whose marginal reaches it: text, start
    and end in bytes, marginal."""
    total, most, size, spans = np.zeros(len(texts)), np.zeros(len(texts)), np.zeros(len(texts)), []
    for base, bounds, slices in _pieces(texts):
        start, end, emission, chain = _tokens_of(slices, model.emission)
        p, _ = marginals(emission, chain, model.moves)
        text = base + np.searchsorted(bounds, start, side="right") - 1
        total += np.bincount(text, np.where(p >= CERTAIN, p, 0), len(texts))
        size += np.bincount(text, minlength=len(texts))
        np.maximum.at(most, text, p)
        if least is not None:
            for i in np.flatnonzero(p >= least).tolist():
                at = int(bounds[text[i] - base])
                spans.append((int(text[i]), int(start[i]) - at, int(end[i]) - at, float(p[i])))
    if model.constant is not None:
        return np.full(len(texts), model.constant), spans
    return 1 / (1 + np.exp(-np.clip(_document_features(total, most, size) @ model.document, -30, 30))), spans


def _tagged(features: np.ndarray, doc: np.ndarray, toxic: np.ndarray):
    """Features with ``LEAST`` contexts, the tokens' columns among them (-1: none), which tokens
    have a marked feature, and the tokens' labels. One kind of feature at a time, which bounds
    the memory."""
    n, width = features.shape
    word = features[:, 0]
    context = mix(np.r_[U(0), word[:-1]][:n] * U(3) + np.r_[word[1:], U(0)][:n])
    bad_token = toxic[doc]
    counts = []
    for k in range(width):
        keys, place = np.unique(features[:, k], return_inverse=True)
        place = place.astype(np.int32)
        _, one = np.unique(mix(context + features[:, k] * U(5) + bad_token.astype(np.uint64)), return_index=True)
        bad = np.bincount(place[one][bad_token[one]], minlength=len(keys)).astype(float)
        good = np.bincount(place[one][~bad_token[one]], minlength=len(keys)).astype(float)
        counts.append((keys, place, bad, good))
    all_bad, all_good = (sum(float(c[i].sum()) for c in counts) for i in (2, 3))
    share = all_bad / max(1.0, all_bad + all_good)
    able, column, kept_keys, base = np.zeros(n, bool), np.empty((n, width), np.int32), [], 0
    for k, (keys, place, bad, good) in enumerate(counts):
        both = bad + good
        with np.errstate(divide="ignore", invalid="ignore"):
            g2 = 2 * (np.nan_to_num(bad * np.log(bad / (both * share))) + np.nan_to_num(good * np.log(good / (both * (1 - share)))))
        marked = (g2 > MARKED) & (bad * (1 - share) >= 8 * good * share)
        kept = both >= LEAST
        able |= marked[place]
        column[:, k] = np.where(kept, base + np.cumsum(kept) - 1, -1)[place]
        kept_keys.append(keys[kept])
        base += int(kept.sum())
    found = np.concatenate(kept_keys)
    order = np.argsort(found)
    rank = np.append(np.argsort(order), -1).astype(np.int32)  # the last stands for "none"
    return found[order], rank[column], able, able & bad_token


def fit(texts: list[bytes], labels: list[int], counts: tuple[int, int]) -> Model:
    """``counts``: clean and toxic rows among all that may be learned from."""
    empty = np.empty(0, np.uint64), np.empty(0), 0.0, np.zeros((2, 2)), np.zeros(5)
    toxic = np.array(labels, bool)
    if not toxic.any() or toxic.all():
        return Model(*empty, constant=counts[1] / max(1, sum(counts)) if toxic.any() else 0.0)
    parts, docs, chains = [], [], []
    for base, bounds, slices in _pieces(texts):
        start, _, features, chain = _tokens_of(slices, lambda f: f)
        parts.append(features)
        docs.append(base + np.searchsorted(bounds, start, side="right") - 1)
        chains.append(chain + (chains[-1][-1] + 1 if chains and len(chains[-1]) else 0))
    features, doc, chain = np.concatenate(parts), np.concatenate(docs), np.concatenate(chains)
    keys, column, able, label = _tagged(features, doc, toxic)
    column = np.where(column < 0, len(keys), column)

    # sentences with a marked token, toxic or not, and of the others four times as many
    n_chains = int(chain[-1]) + 1 if len(chain) else 0
    hit = np.bincount(chain, able, n_chains) > 0
    spare = np.flatnonzero(~hit)
    spare = spare[np.argsort(mix(spare.astype(np.uint64) + U(5)))[:4 * max(1, int(hit.sum()))]]
    chosen = hit.copy()
    chosen[spare] = True
    rows = np.flatnonzero(chosen[chain])
    col, y, own = column[rows], label[rows].astype(float), chain[rows]
    theta = np.zeros(len(keys) + 1 + 1 + 4)  # weights, none, bias, moves
    n = len(keys) + 1
    observed = np.zeros((2, 2))
    inside = own[1:] == own[:-1]
    np.add.at(observed, (y[:-1][inside].astype(int), y[1:][inside].astype(int)), 1)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, STEPS + 1):
        expected = np.zeros((2, 2))
        emission = theta[col].sum(1) + theta[n]
        p, _ = marginals(emission, own, theta[n + 1:].reshape(2, 2), expected)
        gap = p - y
        slope = np.r_[np.bincount(col.ravel(), np.repeat(gap, col.shape[1]), n), gap.sum(), (expected - observed).ravel()]
        slope = slope + 0.1 * theta
        slope[n - 1] = 0
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope ** 2
        theta -= RATE * mean / (1 - 0.9 ** k) / (np.sqrt(spread / (1 - 0.99 ** k)) + 1e-8)
        theta[n - 1] = 0
    used = np.abs(theta[:n - 1]) > 0.02
    model = Model(keys[used], theta[:n - 1][used], float(theta[n]), theta[n + 1:].reshape(2, 2).copy(), np.zeros(5))

    p, _ = marginals(model.emission(features), chain, model.moves)
    most = np.zeros(len(texts))
    np.maximum.at(most, doc, p)
    x = _document_features(np.bincount(doc, np.where(p >= CERTAIN, p, 0), len(texts)), most, np.bincount(doc, minlength=len(texts)))
    weight = np.where(toxic, counts[1] / toxic.sum(), counts[0] / (~toxic).sum())
    weight /= weight.mean()
    b = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps with a ridge
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (q - toxic)) + 0.05 * b
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(b))
        b -= np.linalg.solve(curve, slope)
    model.document = b
    return model


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """Fit to a bounded sample of the labelled rows that are not held out."""
    open_ = labels.where(~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull() & F.col(toxic).isin(0, 1)).select(
        F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("y"))
    short = docs.where(F.length(F.coalesce(F.col(text), F.lit(""))) <= FIT_CHARS).select(F.col(doc_id).alias("id"))
    known = open_.join(short, "id", "left_semi").select("id", "y").distinct()
    counts = {y: n for y, n in open_.groupBy("y").count().collect()}  # at most two rows
    first = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS)
    chosen = first(0).unionByName(first(1))  # FIT_ROWS of each label at most: small enough to broadcast
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sample = docs.where(F.length(F.coalesce(F.col(text), F.lit(""))) <= FIT_CHARS).select(F.col(doc_id).alias("id"), body.alias("t")).join(
        F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("t").alias("t"))
    known_counts = counts.get(0, 0), counts.get(1, 0)

    def run(batches):
        rows = [r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        model = fit([t for _, t in rows], [y for y, _ in rows], known_counts)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    # a bounded sample is fitted by one task; the driver sees the model only
    made = sample.repartition(1).sortWithinPartitions("id", "y").select("y", "t").mapInArrow(run, "model binary").first()
    return pickle.loads(made.model) if made else fit([], [], known_counts)


def score_documents(docs: DataFrame, model: Model, text: str = "text", into: str = "score", spans: str | None = None) -> DataFrame:
    """Add the score, and the offending tokens (start, end by code points, marginal) if asked."""
    told = docs.sparkSession.sparkContext.broadcast(model)
    names = [into] + [spans] * (spans is not None)
    kept = [c for c in docs.columns if c not in names]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    given = docs.select(*kept, *[F.col(text)] * (text not in kept))
    schema = docs.select(*kept, F.lit(0.0).alias(into), *[F.expr("array(named_struct('start', 0L, 'end', 0L, 'p', 0D))").alias(s) for s in names[1:]]).schema

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(b.schema.get_field_index(text)).cast(pa.binary()).to_pylist()]
            found, toxic = score(told.value, texts, 0.5 if spans is not None else None)
            columns = [b.column(b.schema.get_field_index(c)) for c in kept] + [pa.array(found)]
            if spans is not None:
                rows: list[list] = [[] for _ in texts]
                own, before = -1, np.empty(0, np.int64)
                for i, start, end, p in toxic:
                    if i != own:  # characters before each byte: bytes that go on with one don't count
                        own, before = i, np.cumsum(np.r_[0, (np.frombuffer(texts[i], np.uint8) & 0xC0) != 0x80])
                    rows[i].append({"start": int(before[start]), "end": int(before[end]), "p": p})
                columns.append(pa.array(rows, kind))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return given.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The documents whose score stays below the threshold."""
    return score_documents(docs, train(docs, labels, doc_id, text), text, "__score").where(F.col("__score") < threshold).drop("__score")
