"""Katz backoff against plain Python over the definition."""
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarterline.llm import katz
from quarterline.llm.packing import pack, steps, sums, unpack
from quarterline.llm.queries import QUERIES

TOP = 5


def kept(counts):
    n = Counter(counts)
    for top in range(TOP, 0, -1):
        if all(n[r] for r in range(1, top + 2)):
            over = (top + 1) * n[top + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - over) / (1 - over) for r in range(1, top + 1)} if over < 1 else {1: 0}
            if all(0 < x < 1 for x in d.values()):
                return d, n
    return {r: (r - 0.5) / r for r in range(1, TOP + 1)}, n


class Plain:
    """The model in dictionaries; chances by recursion."""

    def __init__(self, texts):
        self.uni, self.after = Counter(), defaultdict(Counter)
        for t in texts:
            before = "<s>"
            for w in self.tokens(t):
                self.uni[w] += 1
                self.after[before][w] += 1
                before = w
        self.total = sum(self.uni.values())
        self.d1, n = kept(self.uni.values())
        self.d2, _ = kept([c for f in self.after.values() for c in f.values()])
        rest = sum(c * (1 - self.d1.get(c, 1)) for c in self.uni.values())
        self.whole = self.total if rest > 0 else self.total + 1
        self.types = 1 + n[1] * (n[1] - 1) // (2 * (n[2] + 1))
        self.unseen = (rest or 1) / self.whole / self.types

    @staticmethod
    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in low.translate({k: " " for k in range(9, 14)}).split(" ") if w] + ["\n"]

    def one(self, w):
        c = self.uni[w] if w in self.uni else 0
        return c * self.d1.get(c, 1) / self.whole if c else self.unseen

    def two(self, v, w):
        f = self.after.get(v)
        if not f:
            return self.one(w)
        rest = sum(c * (1 - self.d2.get(c, 1)) for c in f.values())
        total = sum(f.values()) + (0 if rest else 1)
        if w in f:
            return f[w] * self.d2.get(f[w], 1) / total
        return (rest or 1) / total / (1 - sum(self.one(x) for x in f)) * self.one(w)

    def score(self, text):
        tokens = self.tokens(text)
        return (len(tokens), sum(w in self.uni for w in tokens), self.total,
                sum(math.log10((self.uni.get(w, 0) + 1) / (self.total + len(self.uni) + 1)) for w in tokens),
                sum(math.log10(self.two(v, w)) for v, w in zip(["<s>", *tokens], tokens)))


def corpus(n, seed=4):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.8))}" for _ in range(2000)]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(40))) + rng.choice(["", " The the THE", "\ttail"])) for i in range(n)]


def asked(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return QUERIES["op11_katz_backoff"](spark, str(folder))


def same(got, rows):
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    model = Plain([t for i, t in rows if not out(i)])
    want = sorted([(i, out(i), *model.score(t)) for i, t in rows], key=str)
    got = sorted([tuple(r)[:-1] for r in got.collect()], key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=0, atol=2e-6)
    return model


@pytest.mark.parametrize("batch, parts", [(1 << 24, 4), (2000, 9)])
def test_query(spark, odd_documents, no_documents, tmp_path, monkeypatch, batch, parts):
    """With small batches and many parts, hot contexts are dealt out."""
    monkeypatch.setattr(katz, "BATCH_BYTES", batch)
    more = spark.createDataFrame([(i + 100, t) for i, t in corpus(500)], "doc_id long, text string")
    docs = odd_documents.where("doc_id is null or doc_id not in (6, 7)").unionByName(more, allowMissingColumns=True)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = asked(spark, docs, tmp_path / "a")
        assert got.columns[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        model = same(got, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
        assert max(sum(f.values()) for f in model.after.values()) * parts > 1.5 * model.total or parts == 4
        assert asked(spark, no_documents, tmp_path / "b").collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_chances_add_to_one(spark):
    """Over all words and the unseen ones, after every context, seen or not."""
    rows = corpus(60, 9)
    model = Plain([t for _, t in rows])
    for v in [*model.after, "never"]:
        total = sum(model.two(v, w) for w in model.uni) + model.types * model.two(v, "unheard-of")
        assert abs(total - 1) < 1e-9
    # the same chances by the operator, from texts of one word more
    docs = spark.createDataFrame([(t, True) for _, t in rows] + [(f"w1 {w}", False) for w in ("w2", "tail", "unheard-of")], "text string, taught boolean")
    got, stored = katz.score(docs.withColumn("id", F.monotonically_increasing_id()), "id", "text", F.col("taught"))
    score = [r.score for r in got.where("not taught").orderBy("id").collect()]
    assert np.allclose(score, [model.score(f"w1 {w}")[-1] for w in ("w2", "tail", "unheard-of")])
    assert stored.unigrams.agg(F.sum("total")).first()[0] == stored.bigrams.agg(F.sum("total")).first()[0] == model.total
    counts = Counter()
    for r in stored.bigrams.collect():
        contexts, sizes, seconds, place, count = unpack(r.blob)
        counts.update(zip(np.repeat(sums(contexts), sizes).tolist(), sums(seconds)[place].tolist(), count.tolist()))
    assert sorted(c for (*_, c), _ in counts.items()) == sorted(c for f in model.after.values() for c in f.values())


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    got, _ = katz.score(docs, "id", "text", F.lit(None).cast("boolean"))
    assert [(r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.orderBy("id").collect()] == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_very_long_texts(spark, odd_documents):
    docs = odd_documents.where("doc_id in (1, 6, 7)").select("doc_id", "text")
    got, _ = katz.score(docs, "doc_id", "text", F.col("doc_id") != 7)
    model = Plain([r.text for r in docs.where("doc_id != 7").collect()])
    for r in got.collect():
        want = model.score(docs.where(F.col("doc_id") == r.doc_id).first().text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert np.allclose([r.base_score, r.score], want[3:], rtol=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=30), st.lists(st.floats(0, 1), max_size=5))
def test_packing(numbers, doubles):
    keys = np.unique(np.array(numbers, np.uint64))
    a, b, c = unpack(pack(np.array(numbers, np.uint64), steps(keys), np.array(doubles)))
    assert a.tolist() == numbers and sums(b).tolist() == keys.tolist() and c.tolist() == doubles
