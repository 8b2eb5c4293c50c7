"""Encoding and decoding, against the tokenizers library."""
import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarterline.llm import bpe
from quarterline.llm.encoding import LibraryWords, SegmentTreeWords, TextEncoder, read_tokenizer

PATH = bpe.default_tokenizer()
ODD = ["", " ", "  ", "a  b", "a   b", "a \n b", " lead", "trail ", "trail  ", "x\n", "\n x", "a\n \nb", "it's they'll 'S '", "<|endoftext|>",
       "a <|endoftext|> b<|endoftext|>", "　a 　 b", "日本語 テキスト", "é" * 500, "a" * 3000, "ab" * 2000 + " x", "՘ x ₏",
       "\x1c a \x1d", "\r\n \t x", "😀 😀😀", "1 23 4,5 %%% ", "\x85 x", "x \x85", "﻿a", "\0 a\0"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("words", [SegmentTreeWords, LibraryWords])
def test_ids_are_the_librarys(library, words):
    rnd = random.Random(5)
    texts = ODD + ["".join(rnd.choice("ab é \n'st.1 字") for _ in range(rnd.randrange(80))) for _ in range(400)]
    spec = read_tokenizer(PATH)
    own = TextEncoder(spec, words(spec))
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_trees_of_many_words_and_of_one_agree():
    rnd = random.Random(2)
    tree = SegmentTreeWords(read_tokenizer(PATH))
    words = ["".join(rnd.choice("abcdefghthein") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(500)]
    assert tree.encode(words) == [tree._long(w) for w in words]


def test_table(spark, library, odd_documents):
    rows = bpe.round_trip_digests(odd_documents, "text", PATH).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    # a column with a result's name is replaced, the others stay
    assert bpe.encode(odd_documents, "text", PATH).columns.count("ids") == 1
    assert set(odd_documents.columns) <= set(bpe.encode(odd_documents, "text", PATH).columns)


def test_round_trip(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(99, None)], "n int, text string")
    back = bpe.decode(bpe.encode(df, "text", PATH), "ids", PATH)
    assert all((r.text or "") == r.decoded for r in back.collect())


def test_empty(spark, no_documents):
    assert bpe.round_trip_digests(no_documents, "text", PATH).isEmpty()


def test_words_are_asked_for_once(monkeypatch):
    """The library's model sees a word when a text first comes to it; plain words are not cut."""
    told = read_tokenizer(PATH)
    words, asked, cut = LibraryWords(told), [], []
    monkeypatch.setattr(LibraryWords, "one", lambda self, w, one=LibraryWords.one: asked.append(w) or one(self, w))
    monkeypatch.setattr(TextEncoder, "_cut", lambda self, t, own=TextEncoder._cut: cut.append(t) or own(self, t))
    enc = TextEncoder(told, words)
    texts = ["the cat saw the cat", "the dog, the cat", "the dog,", "PAD the cat<|endoftext|>"]
    got = list(enc.encode(texts))
    assert sorted(asked) == sorted(["the", " cat", " saw", " the", " dog", ",", "PAD"])
    assert cut == ["the", "the", " dog,", "the", "PAD", " cat<|endoftext|>"]
    plain = Tokenizer.from_str(told)
    assert got == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
