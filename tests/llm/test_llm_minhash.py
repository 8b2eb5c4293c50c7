"""Near duplicates, against all pairs."""
import random
import re

import numpy as np
import pytest

from quarterline.llm import minhash_dedup as md
from quarterline.llm.graph import components
from quarterline.llm.words import shingles, word_hashes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_set(text, width):
    words = WORD.findall((text or "").encode().lower())
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingle_set(text, width))
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    flat = [(i, s) for i, own in sets.items() for s in own if s]
    for k, (i, s) in enumerate(flat):
        for j, t in flat[:k]:
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both) and root(i) != root(j):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in sets}


def check(spark, rows, width, percent):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = md.near_duplicates(df, "doc_id", "text", width, percent).collect()
    want = brute(rows, width, percent)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    sizes = {(i, len(shingle_set(t, width))) for i, t in rows}
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    return want


def test_families(spark):
    """Copies, families with few and many edits each, chains of edits, short texts."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 6)))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rnd.choice([8, 40, 120]))]
        chain = list(base)
        for k in range(25):
            copy = list(base)
            for _ in range(rnd.randrange(0, 9)):
                copy[rnd.randrange(len(copy))] = word()
            chain[rnd.randrange(len(chain))] = word()
            rows += [" ".join(copy).upper() if k % 5 == 0 else "\t".join(copy), " \n".join(chain)]
    rows += ["", " ", "a", "A", "a b", "a  b", "b a", None, " x y z"]
    rnd.shuffle(rows)
    want = check(spark, list(enumerate(rows)), 3, 85)
    assert len(set(want.values())) < len(rows) - 60
    check(spark, list(enumerate(rows)), 5, 80)


def test_families_of_unlike_texts(spark, monkeypatch):
    """Texts that share most of a template and are still too unlike: the template's shingles are the
    only ones they could be joined on, and no pairs are made of them. A few that are close enough
    to each other are found among them."""
    rnd = random.Random(11)
    word = lambda: f"v{rnd.randrange(10**9)}"
    template = [word() for _ in range(100)]
    rows = []
    for k in range(600):
        own = [word() for _ in range(24)]
        rows.append(" ".join(template + own))
        if k % 60 == 0:  # two words of its own are others: 80 % of the shingles and more are shared
            rows.append(" ".join(template + own[:-2] + [word(), word()]))
    made = []
    real = md._rest
    monkeypatch.setattr(md, "_rest", lambda *a: made.append(real(*a)) or made[-1])
    want = check(spark, list(enumerate(rows)), 2, 85)
    assert len(set(want.values())) == 600
    assert all(pairs.count() < 200 for pairs in made)


def test_no_link_is_lost_without_hubs(spark, monkeypatch):
    """All links come from the join on rare shingles when hubs link nobody."""
    rnd = random.Random(13)
    pool = [f"p{k}" for k in range(60)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(pool) for _ in range(rnd.choice([6, 12, 30, 80]))]
        for _ in range(5):
            copy = list(base)
            for _ in range(rnd.randrange(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(pool)
            rows.append(" ".join(copy[:len(copy) - rnd.randrange(0, 3)]))
    verified, calls = md._verified, []
    monkeypatch.setattr(md, "_verified", lambda pairs, *a: verified(pairs.where("false") if not calls.append(1) and len(calls) % 2 else pairs, *a))
    for width, percent in ((1, 80), (2, 80), (3, 85)):
        check(spark, list(enumerate(rows)), width, percent)


def test_one_id_twice(spark):
    rows = [(5, "a b c d e f g"), (5, "q r s t u v w"), (7, "a b c d e f g"), (3, "q r s t u v w")]
    assert set(check(spark, rows, 3, 85).values()) == {3}


def test_odd_rows(spark, odd_documents, no_documents):
    got = md.near_duplicates(odd_documents, "doc_id", "text").collect()
    assert len(got) == odd_documents.count()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 1, None: None, 9: 9, 10: 10, -11: -11}
    left = md.drop_near_duplicates(odd_documents, "doc_id", "text")
    assert left.columns == odd_documents.columns
    assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == [-11, 1, 2, 3, 4, 5, 6, 9, 10]
    assert left.where("doc_id is null").count() == 1
    assert md.near_duplicates(no_documents, "doc_id", "text").isEmpty() and md.drop_near_duplicates(no_documents, "doc_id", "text").isEmpty()


def test_rows_are_dropped_by_their_texts(spark):
    """Repeated rows, ids of several texts and rows without id."""
    a, b, c = ("one two three four five six seven eight nine ten eleven twelve " * 2, "another text altogether with nothing of the first in it at all",
               "unique words only here that no other row of the table has")
    near = a.replace("twelve ", "twelve and ", 1)[:-1]
    rows = [(5, a, "x"), (5, a, "x"), (5, a, "b"), (7, a, "x"), (None, a, "x"), (7, c, "x"), (9, near, "x"), (None, b, "y"), (None, b, None), (None, b, "z"),
            (3, " \n", "x"), (3, " \n", "x"), (None, None, "x"), (4, "", "x")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, __n long, component string").repartition(3)
    left = md.drop_near_duplicates(df, "doc_id", "text", 2, 70)
    assert left.columns == df.columns
    # the copy with the smallest id and source; the text that shares its id with a copy; one row without id
    assert sorted((tuple(r)[:3] for r in left.collect()), key=str) == sorted(
        [(5, a, "b"), (7, c, "x"), (None, b, "y"), (3, " \n", "x"), (3, " \n", "x"), (None, None, "x"), (4, "", "x")], key=str)


@pytest.mark.parametrize("sizes, j", [((40, 40, 10), 4 / 9), ((3, 1, 0), 0.75), ((500, 100, 100), 5 / 7)])
def test_sketches(sizes, j):
    """Every coordinate fills, whatever the set's size, and agrees as often as sets are alike."""
    both, one, two = sizes
    agree = []
    for seed in range(60):
        rnd = np.random.default_rng(seed)
        x = np.unique(rnd.integers(0, 2**63, both + one + two, dtype=np.uint64))
        rnd.shuffle(x)
        a, b = np.sort(x[:both + one]), np.sort(np.r_[x[:both], x[both + one:]])
        s = md.sketches(np.r_[a, b], np.array([len(a), len(b)]))
        assert (s != md.EMPTY).all()
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - j) < 0.05
    assert (md.sketches(np.empty(0, np.uint64), np.array([0])) == md.EMPTY).all()


def test_words_of_long_texts():
    """Slices do not change words."""
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9))) for _ in range(400_000)).encode()
    (long, _), = word_hashes([text])
    parts = text.split()
    short = np.concatenate([f for f, _ in word_hashes([b" ".join(parts[k:k + 1000]) for k in range(0, len(parts), 1000)])])
    assert np.array_equal(long, short)
    whole = [f for f, _ in word_hashes([b"x" * 3_000_000 + b" y"])]
    assert len(whole[0]) == 2
    found, counts = next(word_hashes([b"a b a b a b", b"", b"a b"]))
    sets, n = shingles(found, counts, 3)
    assert n.tolist() == [2, 0, 1] and len(sets) == 3


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (21, 20), (4, 4)] + [(100 + i, 100) for i in range(50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3)}, **{i: 5 for i in range(5, 10)}, 20: 20, 21: 20, **{100 + i: 100 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()
