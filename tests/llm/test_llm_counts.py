"""Rollups of signed changes."""
import collections

import pytest

from quarterline.llm import bpe, token_counts as tc
from quarterline.plans.lineage import new_path

CHANGE = ("op string, source string, lang string, tokenizer string, n_tokens long, "
          "old_source string, old_lang string, old_tokenizer string, old_tokens long")


def test_batches(spark):
    rollup = tc.Rollup(spark, new_path(spark, "rollup"))
    none = (None,) * 4
    batches = [
        ("a", [("insert", "s", "en", "t1", 10, *none), ("insert", "s", "en", "t1", 5, *none), ("insert", None, "fr", "t1", None, *none)]),
        ("b", [("delete", "s", "en", "t1", 5, *none), ("revise", "s", "en", "t2", 8, "s", "en", "t1", 10), ("insert", "r", None, "t1", 0, *none)]),
        ("c", []),
    ]
    want = {("s", "en", "t2"): (1, 8), (None, "fr", "t1"): (1, 0), ("r", None, "t1"): (1, 0)}
    for batch, rows in batches:
        assert rollup.apply(batch, spark.createDataFrame(rows, CHANGE))
    for batch, rows in batches:  # once more: nothing changes
        assert not rollup.apply(batch, spark.createDataFrame(rows, CHANGE))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()} == want
    # what was written but not committed does not count, and is replaced
    tc.summed(tc.signed(spark.createDataFrame(batches[0][1], CHANGE))).write.parquet(f"{rollup.folder}/deltas/d")
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()} == want
    assert rollup.apply("d", spark.createDataFrame([("delete", "s", "en", "t2", 8, *none)], CHANGE))
    assert ("s", "en", "t2") not in {tuple(r)[:3] for r in rollup.totals().collect()}


def test_refusals(spark):
    rollup = tc.Rollup(spark, new_path(spark, "rollup"))
    assert rollup.totals().isEmpty()
    with pytest.raises(Exception, match="unknown change"):
        rollup.apply("x", spark.createDataFrame([("upsert", *(None,) * 8)], CHANGE))
    assert rollup.committed() == []
    with pytest.raises(ValueError):
        rollup.apply("../x", spark.createDataFrame([], CHANGE))


def test_counts(spark, odd_documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    rows = odd_documents.select("text", tc.word_count("text").alias("words"), tc.piece_count("text").alias("pieces"),
                                tc.bpe_count(odd_documents, "text", bpe.default_tokenizer()).alias("bpe")).collect()
    for r in rows:
        assert r.words == len((r.text or "").split()) and r.pieces >= r.words
        assert r.bpe == len(library.encode(r.text or "").ids)


def test_query_of_a_table(spark):
    from quarterline.llm.queries import QUERIES

    rows = QUERIES["op8_token_rollup"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = {}
    for d in sorted(docs, key=lambda d: d.doc_id):
        texts.setdefault(d.text or "", d)
    n = collections.Counter((d.source, d.lang) for d in texts.values())
    assert {(r.source, r.lang): r.documents for r in rows if r.tokenizer == "words-2"} == dict(n)
    assert {r.tokenizer for r in rows} == {"words-2", "byte_bpe_50k-1"}


def test_query_of_rows_without_id(spark, tmp_path):
    """They come after all others of their text; of a text without any id one row stays."""
    from quarterline.llm.queries import QUERIES

    rows = [(2, "a b c", "s2"), (1, "a b c", "s1"), (None, "a b c", "s3"), (None, "d e", "s4"), (None, "d e", "s4"), (None, "f.", "s5"), (None, None, "s6")]
    spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {(r.source, r.tokenizer): (r.documents, r.tokens) for r in QUERIES["op8_token_rollup"](spark, str(tmp_path)).collect()}
    assert {k[0]: v for k, v in got.items() if k[1] == "words-2"} == {"s1": (1, 3), "s4": (1, 2), "s5": (1, 2), "s6": (1, 0)}
    assert {k[0]: v[0] for k, v in got.items() if k[1] != "words-2"} == {"s1": 1, "s4": 1, "s5": 1, "s6": 1}
    assert {k[1] for k in got} == {"words-2", "byte_bpe_50k-1"}


def test_totals_of_a_table(spark, tmp_path):
    """All totals, BPE among them, against a plain count with the tokenizers library."""
    from tokenizers import Tokenizer

    from quarterline.llm.queries import QUERIES

    library = Tokenizer.from_file(bpe.default_tokenizer())
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    docs += [(9_000_000 + i, t, lang, None) for i, (_, t, lang, _) in enumerate(docs[:40])] + [docs[3], docs[3], (None, "no id, one row stays", None, "s"), (None, "no id, one row stays", None, "r")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    first = {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    kept = [d for d in docs if d[0] is not None and d[0] == first[d[1] or ""]] + [(None, "no id, one row stays", None, "r")]
    want = collections.Counter()
    for _, t, lang, source in kept:
        for name, n in (("byte_bpe_50k-1", len(library.encode(t or "", add_special_tokens=False).ids)), ("words-2", None)):
            want[source, lang, name, "documents"] += 1
            if n is not None:
                want[source, lang, name, "tokens"] += n
    got = QUERIES["op8_token_rollup"](spark, str(tmp_path)).collect()
    assert {(r.source, r.lang, r.tokenizer): r.documents for r in got} == {k[:3]: n for k, n in want.items() if k[3] == "documents"}
    assert {(r.source, r.lang): r.tokens for r in got if r.tokenizer == "byte_bpe_50k-1"} == {k[:2]: n for k, n in want.items() if k[3] == "tokens"}


def test_empty_table(spark, no_documents, tmp_path):
    from quarterline.llm.queries import QUERIES

    no_documents.write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op8_token_rollup"](spark, str(tmp_path)).collect() == []


def test_folded_totals(spark, monkeypatch):
    """A rollup that folds has the totals of one that does not, and reads a bounded number of batches."""
    none = (None,) * 4
    plain, folding = tc.Rollup(spark, new_path(spark, "rollup"), 1000), tc.Rollup(spark, new_path(spark, "rollup"), 3)
    for k in range(11):
        rows = spark.createDataFrame([("insert", f"s{k % 2}", "en", "t", k, *none), ("delete", "s0", "en", "t", 1, *none)][:1 + k % 2], CHANGE)
        with monkeypatch.context() as m:
            if k == 5:  # a fold that is cut off before it has its name
                m.setattr(tc, "claim", lambda s, draft, final, real=tc.claim: real(s, draft, final) if "/commits/" in final else (_ for _ in ()).throw(KeyboardInterrupt()))
                with pytest.raises(KeyboardInterrupt):
                    folding.apply(f"b{k}", rows)
            else:
                assert folding.apply(f"b{k}", rows)
        assert plain.apply(f"b{k}", rows) and not folding.apply(f"b{k}", rows)
        assert sorted(map(tuple, folding.totals().collect())) == sorted(map(tuple, plain.totals().collect()))
        assert len(set(folding.committed()) - folding._snapshot()[1]) < 4
    assert len(folding._snapshot()[1]) >= 9 and plain._snapshot() == (None, set())


def test_two_writers_of_one_batch(spark, monkeypatch):
    """Both have seen that it is not there: one commits, the other changes nothing."""
    none = (None,) * 4
    rollup = tc.Rollup(spark, new_path(spark, "rollup"))
    committed = tc.Rollup.committed
    with monkeypatch.context() as m:
        m.setattr(tc.Rollup, "committed", lambda self: [])
        one = rollup.apply("a", spark.createDataFrame([("insert", "s", "en", "t", 10, *none)], CHANGE))
        two = rollup.apply("a", spark.createDataFrame([("insert", "s", "en", "t", 99, *none)], CHANGE))
    assert (one, two) == (True, False) and committed(rollup) == ["a"]
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(1, 10)]
