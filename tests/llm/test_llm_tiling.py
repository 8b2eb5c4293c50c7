"""Greedy string tiling, against its definition."""
import random

import numpy as np
import pytest

from quarterline.llm import decontaminate as dc


def brute(a, b, least):
    free_a, free_b, tiles = [True] * len(a), [True] * len(b), []
    while True:
        best, found = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best >= least:
                    found.append((i, j))
        if best < least:
            return sorted(tiles)
        for i, j in found:
            if all(free_a[i:i + best]) and all(free_b[j:j + best]):
                free_a[i:i + best] = free_b[j:j + best] = [False] * best
                tiles.append((i, j, best))


@pytest.mark.parametrize("seed", range(4))
def test_tiles(seed):
    rnd = random.Random(seed)
    for _ in range(80):
        a = [rnd.randrange(rnd.choice([2, 3, 8])) for _ in range(rnd.randrange(0, 25))]
        b = [rnd.randrange(rnd.choice([2, 3, 8])) for _ in range(rnd.randrange(0, 30))]
        if len(a) > 8 and rnd.random() < 0.6:  # reordered
            k = rnd.randrange(len(a))
            b[3:3] = a[k:] + a[:k]
        least = rnd.choice([2, 3, 5])
        assert sorted(dc.tile(np.array(a, np.uint64), np.array(b, np.uint64), least)) == brute(a, b, least)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
WORDS = ITEM.split()
CASES = {
    1: ("before it " + ITEM + " and after", 12, 1), 2: ("Alpha, BETA: gamma-delta (epsilon) zeta! eta theta iota; kappa lambda mu.", 12, 1),
    3: (" ".join(WORDS[6:] + ["then"] + WORDS[:6]), 12, 2), 4: (" ".join(WORDS[:5]), None, 0), 5: (" ".join(WORDS[:6]), 6, 1),
    6: (" ".join(WORDS[::-1]), None, 0), 7: ("x " * 500_000 + ITEM, 12, 1), 8: (None, None, 0), 9: ("", None, 0),
    10: (" x ".join([" ".join(WORDS[k:k + 4]) for k in (0, 4, 8)]), None, 0),
}


def test_leaks(spark):
    docs = spark.createDataFrame([(i, t, 5, 0.1) for i, (t, _, _) in CASES.items()], "doc_id long, text string, item_id long, coverage double")
    bench = spark.createDataFrame([(7, ITEM), (8, "too short"), (9, None), (None, "words nobody ever writes down anywhere")], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.item_tokens, r.matched_tokens, r.tiles) for r in dc.find_leaks(docs, bench).collect()}
    assert got == {i: (7, 12, n, tiles) for i, (_, n, tiles) in CASES.items() if n}
    left = dc.keep_unleaked(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == CASES.keys() - got.keys()


def test_short_items(spark):
    """Items of fewer tokens than a seed leak where they stand whole."""
    items = [(1, "Too short!"), (2, "one two three four"), (3, "x"), (4, "..."), (5, ITEM), (6, "one two three four")]
    texts = {1: "it is too, short", 2: "too long, short", 3: "one two three; four five", 4: "one two three 4 four", 5: "x x X",
             6: "xx too", 7: "short too " + ITEM, 8: "too", 9: None, 10: "one two three"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    got = sorted(tuple(r) for r in dc.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == [(1, 1, 2, 2, 1.0, 1, 2), (3, 2, 4, 4, 1.0, 1, 4), (3, 6, 4, 4, 1.0, 1, 4), (5, 3, 1, 1, 1.0, 1, 1), (7, 5, 12, 12, 1.0, 1, 12)]
    left = dc.keep_unleaked(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {2, 4, 6, 8, 9, 10}


def test_tokens_of_any_script():
    cut = lambda t: dc.spaced(t.encode()).decode().split()
    assert cut("“don’t” — naïve…über«x» 12½") == ["don", "t", "naïve", "über", "x", "12½"]
    assert cut("我们abc在北京。ひらカナ") == ["我", "们", "abc", "在", "北", "京", "ひ", "ら", "カ", "ナ"]
    assert cut("ที่นี่ हिन्दी e\u0301t") == ["ที่", "นี่", "हिन्दी", "e\u0301t"]
    assert dc.spaced(b"a\xff\xe2b-c") == b"a\xff\xe2b c"


def test_items_without_spaces(spark):
    item = "今天天气很好我们一起去公园散步吧"
    docs = spark.createDataFrame([(1, f"他说：{item}。然后"), (2, "今天我们"), (3, "say “" + ITEM.replace(" ", "—") + "”")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, ITEM)], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.matched_tokens) for r in dc.find_leaks(docs, bench).collect()) == [(1, 7, 16), (3, 8, 12)]


def test_in_blocks(spark, monkeypatch):
    """A benchmark of several blocks finds what one block finds."""
    bench = spark.createDataFrame([(i, ITEM.replace("alpha", f"w{i}")) for i in range(20)] + [(7, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in CASES.items()], "doc_id long, text string")
    whole = sorted(map(tuple, dc.find_leaks(docs, bench).collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 700)
    assert sorted(map(tuple, dc.find_leaks(docs, bench).collect())) == whole and len(whole) > 20
    assert dc.keep_unleaked(docs, bench).count() == len(CASES) - len({r[0] for r in whole})


def test_odd_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert dc.find_leaks(odd_documents, bench).isEmpty() and dc.keep_unleaked(odd_documents, bench).count() == odd_documents.count()
    assert dc.find_leaks(no_documents, bench).isEmpty() and dc.keep_unleaked(no_documents, bench).isEmpty()
    assert dc.find_leaks(odd_documents, bench.where("false")).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_repetitive_tiles(monkeypatch, seed):
    """Common runs found token by token are the ones that windows find."""
    monkeypatch.setattr(dc, "PAIRS", 0)
    test_tiles(seed)
    rnd = random.Random(seed)
    for _ in range(40):
        unit = [rnd.randrange(3) for _ in range(rnd.randrange(1, 4))]
        a, b = (unit * 20)[:rnd.randrange(5, 30)], (unit * 30)[:rnd.randrange(5, 60)]
        b[rnd.randrange(len(b))] = 9
        assert sorted(dc.tile(np.array(a, np.uint64), np.array(b, np.uint64), 3)) == brute(a, b, 3)


def leaks_by_definition(text, items, coverage=0.5, seed=5):
    """(item, matched tokens, tiles, longest) by tiles of the whole text."""
    own, out = dc.spaced(text.encode()).decode().lower().split(), []
    for i, item in items:
        t = dc.spaced((item or "").encode()).decode().lower().split()
        least = min(seed, len(t))
        tiles = brute(t, own, least) if t else []
        if len(t) < seed:
            tiles = tiles[:1]
        matched = sum(n for *_, n in tiles)
        if t and matched and matched >= coverage * len(t):
            out.append((i, matched, len(tiles), max(n for *_, n in tiles)))
    return out


def test_leaks_by_definition(spark):
    """``find_leaks``' matched tokens, tiles and longest tile on random texts of items' parts."""
    rnd = random.Random(9)
    word = lambda n: f"w{rnd.randrange(n)}"
    items = [(i, " ".join(word(12 if i % 3 else 300) for _ in range(rnd.choice([3, 12, 25])))) for i in range(12)] + [(50, "a " * 30), (51, "a b " * 12)]
    texts = []
    for k in range(90):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            t = rnd.choice(items)[1].split()
            a = rnd.randrange(len(t))
            parts += t[a:a + rnd.randrange(2, 30)] if rnd.random() < 0.7 else [word(300) for _ in range(9)]
        texts.append((k, " ".join(parts)))
    texts.append((99, "a " * 70))
    want = sorted((k, *r) for k, t in texts for r in leaks_by_definition(t, items))
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = dc.find_leaks(docs, bench)
    assert sorted((r.doc_id, r.item_id, r.matched_tokens, r.tiles, r.longest) for r in got.collect()) == want and len(want) > 40
    assert {r.doc_id for r in dc.keep_unleaked(docs, bench).collect()} == {k for k, _ in texts} - {r[0] for r in want}


def test_repetitive_texts_take_memory_as_they_are_long():
    """An item of 200 equal words against a megabyte of them: no list of all pairs of windows."""
    import tracemalloc

    index = dc.build_index([(1, b"word " * 200), (2, b"to be or not " * 50)], 5)
    texts = [b"word " * 210_000, b"to be or not " * 16_000]
    tracemalloc.start()
    found = [(t, k, m, n, longest) for t, k, m, n, longest in dc.leaks(index, texts, 0.5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(0, 0, 200, 1, 200), (1, 1, 200, 1, 200)]
    assert peak < 400 << 20


def test_equal_items_and_blocks(spark):
    """Items of one text are met once and leak each; a block is no larger than it may be."""
    bench = spark.createDataFrame([(i, ITEM) for i in range(300)] + [(1000 + i, f"{ITEM} {i}") for i in range(60)] + [(None, ITEM)], "item_id long, text string")
    paths, items = dc.index_files(bench, "item_id", "text", 5, 800)
    assert len(paths) > 4 and items.count() == 361
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    got = {r.item_id for r in dc.find_leaks(docs, bench, block_bytes=800).collect()}
    assert got == {None, *range(300), *range(1000, 1060)}
