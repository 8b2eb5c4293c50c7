"""The stages one after the other."""
import hashlib
import re
import string

import test_llm_minhash as near
import test_llm_secrets as hidden
import test_llm_tiling as tiling
from tokenizers import Tokenizer

import corpus_pipeline
from quarterline.llm import bpe, toxicity


def test_stages_keep_the_columns(spark, odd_documents):
    folder = "/root/testdata/sf0.001"
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} >= {1, 2, 3, 4, 5, 6, 9, 10, -11}, name
    masked = corpus_pipeline.mask_secrets(spark, odd_documents, folder).where("doc_id = 9").first()
    assert masked.text == "[SECRET] and token:short" and masked.n_chars == len(masked.text)


def test_run(spark, tmp_path):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert 0.5 * len(docs) < len(rows) < len(docs)
    seen = set()
    for i, r in rows.items():
        assert docs[i] not in seen, "an exact copy stayed"
        seen.add(docs[i])
        assert not any(b in docs[i] for b in bench)
        ids = library.encode(docs[i], add_special_tokens=False).ids
        if "token" not in docs[i] and "assw" not in docs[i] and r.n_tokens == len(ids):
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_no_rows(spark, no_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.isEmpty()


def tokens(text):
    return [t.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)) for t in re.findall(r"[^\W_]+", text or "")]


def leaked(text, items):
    """Greedy tiles of five tokens or more (of the whole item, if it has fewer) cover half of an item."""
    own = tokens(text)
    for item in items:
        least = min(5, len(item))
        runs = {tuple(item[k:k + least]) for k in range(len(item) - least + 1)}
        if item and any(tuple(own[k:k + least]) in runs for k in range(len(own) - least + 1)):
            if sum(n for _, _, n in tiling.brute(item, own, least)) >= 0.5 * len(item):
                return True
    return False


def test_rows_of_each_stage(spark, tmp_path):
    """The rows kept and their digests, worked out stage by stage in plain Python from the scores.
    The small table has no secrets: a few rows with some are added."""
    folder = str(tmp_path)
    library = Tokenizer.from_file(bpe.default_tokenizer())
    given = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels", "benchmark")}
    more = [(900_000 + k, f"note {k} says {x} and the rest of it stays", "en", "web", 1) for k, x in enumerate(
        ("password = hunter2hunter2", "AKIA" + "Q7" * 8, "deadbeef" * 5 + " with token: abcdefgh1", "token=short"))]
    given["documents"] = given["documents"].unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"))
    for name, rows in given.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    docs, labels, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in given)
    scores = toxicity.score_documents(docs, toxicity.train(docs, labels)).select("doc_id", "text", "score").collect()
    clean = [(r.doc_id, r.text) for r in scores if r.score < 0.7]
    groups = near.brute(clean, 5, 80)
    firsts = [(i, t) for i, t in clean if groups[i] == i]
    items = [tokens(r.text) for r in bench.collect()]
    kept = [(i, hidden.masked(t)) for i, t in firsts if not leaked(t, items)]
    assert len(scores) > len(clean) > len(firsts) > len(kept), "a stage has nothing to drop"
    assert any(t != dict(firsts)[i] for i, t in kept), "nothing to mask"

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in kept:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == sorted(want)


def test_rows_without_id_and_of_one_id(spark, tmp_path):
    """Each text goes its own way: of copies one row stays, and a namesake takes nobody with it."""
    folder = str(tmp_path)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    word = lambda k: " ".join(f"word{k}x{n}" for n in range(20))
    rows = [(None, word(1), "en", "a", 1), (None, word(1), "en", "a", 1), (3, word(2), "en", "a", 1), (3, word(2), "en", "a", 1), (2, word(2), "en", "a", 1),
            (3, word(3), "en", None, None), (None, word(3), "en", "b", 1), (None, None, None, None, None), (8, "password = hunter2hunter2", "en", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(None, word(1)), (2, word(2)), (3, word(3)), (None, ""), (8, "[SECRET]")]
    assert sorted(((r.doc_id, r.decoded_sha256) for r in got), key=str) == sorted(((i, sha(t)) for i, t in want), key=str)
