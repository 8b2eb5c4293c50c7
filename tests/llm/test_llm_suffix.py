"""Repeated byte strings, against all windows."""
import collections
import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest

from quarterline.llm import suffix_dedup


def brute(rows, length):
    seen = collections.Counter(b[s:s + length] for _, b in rows for s in range(len(b) - length + 1))
    out = []
    for i, b in rows:
        gone = [False] * len(b)
        end = 0
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                for k in range(max(s, end), s + length):
                    gone[k] = True
                end = s + length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def rows_of(seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcd \n") for _ in range(rnd.choice([30, 60, 200, 500]))) for _ in range(12)]
    rows = []
    for i in range(90):
        t = ""
        for _ in range(rnd.randrange(0, 5)):
            b = rnd.choice(base)
            k = rnd.randrange(len(b))
            t += b[k:k + rnd.randrange(10, 400)] if rnd.random() < 0.7 else "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(60)))
            if rnd.random() < 0.2:  # short periods
                t += ("ab " if rnd.random() < 0.5 else "x") * rnd.randrange(100)
            if rnd.random() < 0.3 and t:
                k = rnd.randrange(len(t))
                t = t[:k] + "Z" + t[k + 1:]
        rows.append((i, t if i % 17 else None))
    return rows + [(500, rows[3][1]), (3, rows[3][1]), (4, "another text of that id " * 3), (None, base[2] + "tail")]


@pytest.mark.parametrize("seed, together", [(1, 4096), (2, 3)])
def test_windows(spark, seed, together):
    """Buckets met in tasks, and (three suffix groups a task at most) by grouping."""
    rows = rows_of(seed)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, body string, n long, place int").repartition(3)
    want = sorted((str(i), n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute([(i, (t or "").encode()) for i, t in rows], 50))
    got = sorted((str(r.doc_id), *tuple(r)[1:]) for r in suffix_dedup.removal_report(df, "doc_id", "text", 50, together).collect())
    assert got == want


@pytest.mark.parametrize("together", [4096, 3])
def test_passage_across_slices(spark, monkeypatch, together):
    """Where slices of a text meet, one q-gram has a context in each of them."""
    monkeypatch.setattr(suffix_dedup, "SLICE", 2048)
    rnd = random.Random(7)
    noise = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    shared = noise(400)
    step = 2048 - 50 + 1
    rows = [(i, noise(step * (1 + i % 2) - 200 + 17 * i) + shared + noise(3000)) for i in range(8)]
    rows += [(20 + i, noise(30) + shared[10 * i:10 * i + 300] + noise(40)) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute([(i, t.encode()) for i, t in rows], 50))
    got = sorted(tuple(r) for r in suffix_dedup.removal_report(df, "doc_id", "text", 50, together).collect())
    assert got == want and all(r[2] for r in want)


def test_text_left(spark):
    rows = rows_of(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((str(i), k) for i, _, _, _, k in brute([(i, (t or "").encode()) for i, t in rows], 50))
    assert sorted((str(r.doc_id), bytes(r.kept)) for r in suffix_dedup.remove_repeats(df, "doc_id", "text", 50).collect()) == want


def test_odd_rows(spark, odd_documents, no_documents):
    got = {(r.doc_id, r.n_bytes): r for r in suffix_dedup.removal_report(odd_documents, "doc_id", "text").collect()}
    assert {k[0] for k, r in got.items() if r.n_removed} == {6, 7, 10}
    assert all(r.n_removed == r.n_bytes and r.n_spans == 1 for r in got.values() if r.n_removed)
    assert suffix_dedup.removal_report(no_documents, "doc_id", "text").isEmpty()


class Task:
    """Catches what a step runs in its tasks."""
    def __getattr__(self, name):
        return lambda *a: self

    def mapInArrow(self, run, schema):
        return run


def peak(run, batch):
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_a_task():
    """Six tasks of an executor hold some ten MB each, however many texts a batch has."""
    rnd = random.Random(3)
    texts = [rnd.randbytes(3000) for _ in range(1000)]
    docs = pa.RecordBatch.from_pydict({"text": pa.array(range(1000), pa.int64()), "body": pa.array(texts, pa.binary())})
    assert peak(suffix_dedup._anchors(Task(), 128, 400), docs) < 40
    n = 4000
    spots = {k: pa.array(v, pa.int64()) for k, v in {
        "gram": [i // 2 for i in range(n)], "text": range(n), "place": [272] * n, "low": [0] * n, "high": [272] * n}.items()}
    contexts = pa.RecordBatch.from_pydict({**spots, "context": pa.array([rnd.randbytes(672) for _ in range(n)], pa.binary())})
    assert peak(suffix_dedup._small_buckets(Task(), 128, 400), contexts) < 60
