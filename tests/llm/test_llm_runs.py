"""Periodic runs against a search over all starts and periods."""
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterline.llm import runs
from quarterline.llm.queries import QUERIES
from quarterline.llm.recompression import extensions, grammar


def brute(words, exponent=4, least=6):
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                length = j - i + q
                if length >= max(least, exponent * q):
                    found.setdefault((i, length), q)
            i = max(j, i) + 1
    rows = sorted((s, length, q) for (s, length), q in found.items())
    drop = {k for s, length, q in rows for k in range(s + q, s + length)}
    return sorted(rows, key=lambda r: (r[0], r[2])), [w for k, w in enumerate(words) if k not in drop]


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


def texts_to_try():
    rng = random.Random(5)
    yield []
    yield ["x"]
    yield ["x"] * 5
    yield ["x"] * 6
    yield ["x"] * 3000
    yield fibonacci(2000)
    yield ["a", "b"] * 500 + ["c"] + ["a", "b"] * 400
    for size in (7, 40, 300, 900):
        for letters in (1, 2, 3):
            yield [rng.choice("abcdef"[:letters]) for _ in range(size)]
    for _ in range(30):
        words = [rng.choice("abcdefgh") for _ in range(rng.randrange(200))]
        for _ in range(3):
            unit = [rng.choice("abc") for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(words) + 1)
            words[at:at] = (unit * 8)[:rng.randrange(3 * len(unit), 8 * len(unit))]
        yield words


def test_runs_and_collapsed_texts():
    cases = list(texts_to_try())
    joined = ["  ".join(w).encode() for w in cases]
    for words, (rows, text) in zip(cases, runs.runs_of_texts(joined), strict=True):
        want, kept = brute(words)
        assert [tuple(r) for r in rows.tolist()] == want
        assert text == " ".join(kept).encode()


def test_other_exponents():
    words = fibonacci(300) + ["z"] + ["a", "b", "a"] * 3
    for exponent, least in ((2, 2), (2, 6), (3, 3), (5, 9)):
        (rows, _), = runs.runs_of_texts([" ".join(words).encode()], exponent, least)
        assert [tuple(r) for r in rows.tolist()] == brute(words, exponent, least)[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 6))
def test_extensions(values, times):
    s = np.array([*values * times, 3])
    n = len(s)
    i, j = (x.ravel() for x in np.triu_indices(n, 1))
    want = []
    for a, b in zip(i.tolist(), j.tolist()):
        k = 0
        while b + k < n and s[a + k] == s[b + k]:
            k += 1
        want.append(k)
    assert extensions(grammar(s), i, j).tolist() == want


def test_grammar_is_small():
    s = np.r_[np.tile(np.arange(5), 200_000), 5]
    levels = grammar(s)
    assert len(levels) < 40 and sum(len(x.symbols) for x in levels) < 4 * len(s)


def varied(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    rows, kept = brute(varied(doc_id, (text or "").encode().split()))
    best = None
    for r in rows:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(rows), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in rows).encode()), sha(b" ".join(kept)))


def asked(spark, docs, folder):
    docs.write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return QUERIES["op13_periodic_runs"](spark, str(folder))


def test_query(spark, odd_documents, no_documents, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["la", "le", "été", "x" * 40]) for _ in range(rng.randrange(120)))) for i in range(300)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    docs = odd_documents.where("doc_id is null or doc_id not in (6, 7)").unionByName(more, allowMissingColumns=True)
    got = asked(spark, docs, tmp_path / "a")
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    want = [expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(want, key=key)
    assert any(r[1] for r in want) and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in want)
    assert asked(spark, no_documents, tmp_path / "b").collect() == []


def test_very_long_texts(spark, odd_documents):
    got = runs.periodic_runs(odd_documents.where("doc_id in (6, 7)"), "doc_id", "text").collect()
    assert [[tuple(x) for x in r.runs] for r in got] == [[(0, 240_000, 4)]] * 2
    assert {r.collapsed for r in got} == {"la maison est grande"}


def test_periods_below_two_are_refused(odd_documents):
    with pytest.raises(ValueError):
        runs.periodic_runs(odd_documents, "doc_id", "text", exponent=1)
