"""Every text query has SQL or is held against a plain version by a named test."""
import importlib

import pytest

import corpus_pipeline
from quarterline.llm.oracle import ORACLE
from quarterline.llm.queries import QUERIES

PLAIN = {
    "op4_token_files": "test_llm_queries.test_files_query",
    "op5_toxicity_crf": "test_llm_toxicity.test_held_out",
    "op6_suffix_dedup": "test_llm_suffix.test_windows",
    "op7_bpe_round_trip": "test_llm_queries.test_round_trip_query",
    "op8_token_rollup": "test_llm_counts.test_totals_of_a_table",
    "op10_string_tiling": "test_llm_tiling.test_leaks_by_definition",
    "op13_periodic_runs": "test_llm_runs.test_query",
    "pipeline": "test_llm_pipeline.test_rows_of_each_stage",
}


def test_every_query_is_held_against_something():
    names = {*QUERIES, "pipeline"} - ({"pipeline"} if corpus_pipeline.ORACLE_SQL else set())
    assert names == {*ORACLE, *PLAIN} and not ORACLE.keys() & PLAIN.keys()
    for where in PLAIN.values():
        module, test = where.split(".")
        assert callable(getattr(importlib.import_module(module), test))


@pytest.fixture(scope="module")
def table(spark, odd_documents, tmp_path_factory):
    """The small table's documents and odd ones, as a table of its own, and its rows."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd_documents, allowMissingColumns=True).where("doc_id is not null and doc_id <> 7")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder), [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    from quarterline.llm import bpe

    return Tokenizer.from_file(bpe.default_tokenizer())


def test_round_trip_query(spark, table, library):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in table[1]:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, QUERIES["op7_bpe_round_trip"](spark, table[0]).collect())) == sorted(want)


def test_files_query(spark, table, library):
    import struct
    import zlib

    want, start = [], 0
    for i, t in sorted(table[1], key=lambda r: (r[0], r[1].encode())):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert sorted(map(tuple, QUERIES["op4_token_files"](spark, table[0]).collect())) == sorted(want)
