"""The random field against all paths, and held-out accuracy."""
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterline.llm import toxicity as tox


def test_marginals():
    """Forward-backward against the sum over all paths, chains of all lengths."""
    rnd = np.random.default_rng(3)
    moves = rnd.normal(size=(2, 2))
    lengths = [1, 2, 3, 5, 8, 1, 7]
    emission = rnd.normal(size=sum(lengths)) * 2
    chain = np.repeat(np.arange(len(lengths)), lengths)
    pairs = np.zeros((2, 2))
    got, logz = tox.marginals(emission, chain, moves, pairs)
    want, want_pairs, want_logz, at = np.zeros(len(emission)), np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        total = 0.0
        p, two = np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(emission[at + t] for t in range(n) if path[t]) + sum(moves[path[t - 1], path[t]] for t in range(1, n)))
            total += w
            p += w * np.array(path)
            for t in range(1, n):
                two[path[t - 1], path[t]] += w
        want[at:at + n] = p / total
        want_pairs += two / total
        want_logz += np.log(total)
        at += n
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs) and np.isclose(logz, want_logz)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_blocks_change_nothing(monkeypatch, block):
    """Chains passed in blocks, against the same chains passed token by token."""
    rnd = np.random.default_rng(block)
    lengths = rnd.integers(1, 200, 40)
    emission, moves = rnd.normal(size=lengths.sum()) * 6, rnd.normal(size=(2, 2)) * 3
    chain = np.repeat(np.arange(len(lengths)), lengths)
    want_pairs, got_pairs = np.zeros((2, 2)), np.zeros((2, 2))
    want, want_logz = tox.marginals(emission, chain, moves, want_pairs)
    monkeypatch.setattr(tox, "CHAIN", block)
    got, got_logz = tox.marginals(emission, chain, moves, got_pairs)
    assert np.allclose(got, want) and np.allclose(got_pairs, want_pairs) and np.isclose(got_logz, want_logz)


def test_slices_change_nothing(monkeypatch):
    """A sentence across slices of a text is one chain, and offsets are the text's."""
    rows = corpus(400)
    model = tox.fit([t.encode() for _, t, _ in rows], [y for _, _, y in rows], (280, 120))
    text = " ".join(t if i % 7 else t.replace(".", "") for i, t, _ in rows).encode()
    want, spans = tox.score(model, [text], 0.5)
    monkeypatch.setattr(tox, "SLICE", 300)
    got, again = tox.score(model, [text], 0.5)
    assert np.allclose(got, want) and len(spans) > 100
    assert [s[:3] for s in again] == [s[:3] for s in spans] and np.allclose([s[3] for s in again], [s[3] for s in spans])


def test_query_gives_offsets(spark, tmp_path):
    from quarterline.llm.queries import QUERIES

    rows = [(i, "été à " + t, y) for i, t, y in corpus(300)]
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in QUERIES["op5_toxicity_crf"](spark, str(tmp_path)).collect()}
    assert list(next(iter(got.values())).asDict()) == ["doc_id", "held_out", "score", "predicted", "toxic_offsets"]
    marked = 0
    for i, text, y in rows:
        words = [text[int(a):int(b)].lower() for a, b in (x.split(":") for x in got[i].toxic_offsets.split(",") if x)]
        assert all(w in ("vile", "grotty") or w.startswith("blargh") for w in words)
        marked += len(words)
    assert marked > 150


def corpus(n, seed=1):
    rnd = random.Random(seed)
    plain = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(5, 60))]
        toxic = rnd.random() < 0.3
        for _ in range(rnd.randrange(2, 6) if toxic else 0):
            words.insert(rnd.randrange(len(words)), rnd.choice(["Vile", "grotty,", "blargh" + rnd.choice(["a", "el", "ix", "um", "or", "is"])]))
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def test_held_out(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, "s", 1.0) for i, t, _ in rows], "doc_id long, text string, score string, predicted double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = tox.train(docs, labels)
    got = {r.doc_id: r for r in tox.score_documents(docs, model, spans="found").withColumn("held", tox.held_out(F.col("doc_id"))).collect()}
    assert len(got) == len(rows)
    for i, text, y in rows:
        assert got[i].held == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1
    held = [(got[i].score >= 0.7) == bool(y) for i, _, y in rows if got[i].held]
    assert len(held) > 200 and np.mean(held) > 0.98
    for i, text, y in rows:  # offending offsets
        marked = {text[s.start:s.end].lower() for s in got[i].found}
        assert all(w in ("vile", "grotty") or w.startswith("blargh") for w in marked)
    # labels of held-out rows are never looked at
    turned = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(tox.train(docs, turned).document, model.document)


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus(300)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(300)], "doc_id long, text string")
    model = tox.train(docs, labels)
    got = tox.score_documents(odd_documents, model).collect()
    assert len(got) == odd_documents.count() and all(0 <= r.score < 0.7 for r in got)
    assert tox.score_documents(no_documents, model).isEmpty()
    none = labels.where("false")
    for given, want in ((none, 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        assert {r.score for r in tox.score_documents(odd_documents, tox.train(docs, given)).collect()} == {want}
    clean = tox.keep_clean(odd_documents, none)
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count()


def test_a_long_text_is_read_whole():
    rows = corpus(400)
    model = tox.fit([t.encode() for _, t, _ in rows], [y for _, _, y in rows], (280, 120))
    filler = "lorem ipsum " * 200_000
    got, spans = tox.score(model, [(filler + "vile grotty vile blarghum").encode(), filler.encode(), b""], 0.5)
    assert len({s[0] for s in spans}) == 1 and min(s[1] for s in spans) >= len(filler)
