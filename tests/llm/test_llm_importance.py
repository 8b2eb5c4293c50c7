"""Importance resampling against plain Python."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterline.llm import importance
from quarterline.llm.interning import Spans, Table
from quarterline.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spans_of(pieces):
    data = np.frombuffer(b"".join(pieces), np.uint8)
    length = np.array([len(p) for p in pieces], np.int64)
    return Spans(data, np.cumsum(length) - length, length)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=70), min_size=1, max_size=40))
def test_keys_checksums_and_entries(pieces):
    pieces = pieces + pieces[:7]
    spans = spans_of(pieces)
    assert spans.keys().tolist() == [xxhash.xxh64_intdigest(p) for p in pieces]
    assert spans.checksums(np.arange(len(pieces))).tolist() == [zlib.crc32(p) for p in pieces]
    for keys in (None, np.zeros(len(pieces), np.uint64)):  # all keys alike: bytes still tell them apart
        table = Table(spans, 1000, keys)
        slots = table.slots.tolist()
        assert len(set(zip(slots, pieces))) == len(set(slots)) == len(set(pieces))
        assert {p: table.count[s] for p, s in zip(pieces, slots)} == Counter(pieces)
        assert [table.bucket[s] for s in slots] == [zlib.crc32(p) % 1000 for p in pieces]


def features(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [x.encode() for x in w + [" ".join(p) for p in zip(w, w[1:])]]


def plain(docs, target, percent=25, least=20):
    made = [(i, *features(t)) for i, t in docs]
    bucket = lambda f: zlib.crc32(f) % 10000
    s = Counter(bucket(f) for _, _, fs in made for f in fs)
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for i, words, fs in made:
        g = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in map(bucket, fs)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    out = [(r[0], *r[2:], k + 1 if k < percent * len(order) // 100 else None) for k, r in enumerate(order)]
    return out + [(r[0], *r[2:], None) for r in rows if r[1] < least]


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def asked(spark, docs, target, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return QUERIES["op12_importance_draw"](spark, str(folder))


@pytest.fixture(scope="module")
def target():
    return ["The maison of the lazy dog, 42 times", None, "", "grande maison"]


def test_query(spark, odd_documents, no_documents, target, tmp_path, monkeypatch):
    rng = random.Random(1)
    some = ["maison", "Dog", "lazy-dog", "été", "x" * 50, "42"]
    more = spark.createDataFrame([(i, " ".join(rng.choice(some) for _ in range(rng.randrange(60)))) for i in range(100, 400)], "doc_id long, text string")
    docs = odd_documents.unionByName(more, allowMissingColumns=True)
    got = asked(spark, docs, target, tmp_path / "a")
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = by_text(plain(rows, target))
    assert by_text(got.collect()) == want
    assert sum(r[-1] is not None for r in want) == len([1 for _, t in rows if features(t)[0] >= 20]) * 25 // 100
    assert asked(spark, no_documents, [], tmp_path / "b").collect() == []


def test_empty_target(spark, odd_documents, tmp_path):
    rows = [(r.doc_id, r.text) for r in odd_documents.select("doc_id", "text").collect()]
    assert by_text(asked(spark, odd_documents, [], tmp_path / "a").collect()) == by_text(plain(rows, []))


def test_slices_of_long_texts(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "bb", "C" * 30, "--", "é" * 9, "w" * 300]) for _ in range(4000)).encode()
    _, whole = features(text.decode())
    for size in (64, 1000, 10**9):
        monkeypatch.setattr(importance, "BATCH_BYTES", size)
        parts = [b for _, b in importance.batches_of([b"one two", text, b"", b"three"], 2)]
        total = sum(b.counts() for b in parts)
        assert total.sum() == sum(b.words.sum() for b in parts) * 2 - 3 == len(whole) + 4
        want = Counter(zlib.crc32(f) % 10000 for f in [*whole, b"one", b"two", b"one two", b"three"])
        assert {k: int(total[k]) for k in np.flatnonzero(total)} == want


def test_ties_go_by_id_then_features(spark):
    rows = [(k, 30, n, 0, s) for k, n, s in ((3, 5, 10), (1, 5, 10), (2, 9, 11), (None, 1, 10), (1, 4, 10), (4, 5, 9), (5, 5, 10), (6, 5, 10))]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = importance.draw(scored, "doc_id", importance.F.col("n_words") >= 20, 63).where("rank is not null").orderBy("rank").collect()
    assert [(r.rank, r.doc_id, r.n_features) for r in got] == [(1, 2, 9), (2, 1, 4), (3, 1, 5), (4, 3, 5), (5, 5, 5)]
