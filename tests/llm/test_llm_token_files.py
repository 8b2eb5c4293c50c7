"""Blocks and files of ids: exact round trips."""
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarterline.llm import bpe, token_files
from quarterline.llm.pfor import BLOCK, pack_blocks, unpack_block


@pytest.mark.parametrize("n", [0, 1, 7, 8, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 5])
@pytest.mark.parametrize("most", [0, 1, 300, 70_000, 2**32 - 1])
def test_blocks(n, most):
    rnd = np.random.default_rng(n + most)
    values = rnd.integers(0, most, n, dtype=np.uint32, endpoint=True)
    few = np.where(rnd.random(n) < 0.03, values, values % 5).astype(np.uint32)  # outliers
    for v in (values, few):
        for percentile in (0.0, 0.9, 1.0):
            parts = [unpack_block(b) for b in pack_blocks(v, percentile)]
            assert np.array_equal(np.concatenate([np.empty(0, np.uint32), *parts]), v)


def expected(rows, end):
    library = Tokenizer.from_file(bpe.default_tokenizer())
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((i, start, ids))
        start += len(ids)
    return out


def test_files(spark, odd_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    manifest = token_files.write(odd_documents, "doc_id", "text", bpe.default_tokenizer(), 2, file_values=5000)
    want = expected(rows, 2)
    got = sorted(token_files.read(manifest).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, list(r.ids)) for r in got] == want
    sums = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_checksums(manifest).collect()}
    assert sums == {(i, s, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) for i, s, ids in want}
    # by the index of block starts
    for m in manifest.collect():
        file = token_files.TokenFile(m.path)
        inside = [t.tolist() for _, _, t in file.documents()]
        assert [file.tokens(k).tolist() for k in range(len(file.ids))] == inside and sum(map(len, inside)) == m.tokens


def test_empty(spark, no_documents):
    manifest = token_files.write(no_documents, "doc_id", "text", bpe.default_tokenizer(), 2)
    assert manifest.isEmpty() and token_files.read_checksums(manifest).isEmpty()
