"""Archives written and read back."""
import hashlib

import pytest

from quarterline.llm import warc

BIG = "abé" * 400_000
PAGES = [(1, "u\r\nv", BIG), (2, None, BIG), (3, "x", None), (4, "x", ""), (5, "y", "short"), (6, "y", "short"),
         (7, "WARC/1.1\r\n\r\n", "z\r\n\r\nWARC/1.1" * 20), (8, "q", BIG), (9, "q", "x" * 100), (0, "q", "x" * 100), (9, "q", "x" * 100),
         (10, "q", "y" * 99), (11, "q", "y" * 99), (None, "q", "no id"), (None, None, None), (None, "q", BIG), (None, "r", BIG), (None, "s", "only " * 30), (None, "s", "only " * 30)]


@pytest.mark.parametrize("chunk, out", [(70_000, 50_000), (1 << 20, 1 << 20), (7_000_000, 333)])
def test_round_trip(spark, chunk, out):
    pages = spark.createDataFrame([(*p, 1, "c") for p in PAGES], "page_id long, url string, html string, record_id long, chunk string").repartition(3)
    manifest = warc.write(warc.records(pages, "page_id", "url", "html"), chunk=chunk, file_bytes=1000)
    assert manifest.count() > 1
    got = {}
    every = warc.read(manifest, chunk=out).collect()
    # rows without id: one record each, a revisit where the payload has a record with an id
    nameless = sorted((r.record_type, r.refers_to, r.payload_bytes, bytes(r.chunk), r.uri) for r in every if r.record_id is None and r.chunk_no == 0)
    assert nameless == [("response", None, 0, b"", ""), ("response", None, 5, b"no id", "q"), *[("response", None, 150, ("only " * 30).encode(), "s")] * 2,
                        ("revisit", 1, len(BIG.encode()), b"", "q"), ("revisit", 1, len(BIG.encode()), b"", "r")]
    for r in sorted((r for r in every if r.record_id is not None), key=lambda r: (r.record_id, r.chunk_no)):
        got.setdefault(r.record_id, []).append(r)
    want = {p: (h or "").encode() for p, _, h in PAGES if p is not None}
    first = {}
    for p in sorted(want):
        first.setdefault(want[p], p)
    assert got.keys() == want.keys()
    for p, body in want.items():
        rows = got[p]
        last = rows[-1]
        revisit = len(body) >= 100 and first[body] != p
        assert {r.record_type for r in rows} == {"revisit" if revisit else "response"}
        assert last.refers_to == (first[body] if revisit else None)
        assert last.payload_digest == hashlib.sha256(body).hexdigest() and last.payload_bytes == len(body)
        if p != 9:  # the row that comes twice has its chunks twice
            assert b"".join(bytes(r.chunk) for r in rows) == (b"" if revisit else body)
            # each chunk's digest is that of all bytes up to its end
            at = 0
            for r in [] if revisit else rows:
                at += len(r.chunk)
                assert r.digest == hashlib.sha256(body[:at]).hexdigest() and len(r.chunk) <= out
    slim = warc.read(manifest, payload=False).collect()
    assert len(slim) == len(PAGES) and all(len(r.chunk) == 0 for r in slim)


def test_record_ids_are_all_different(spark):
    import gzip
    import re

    pages = spark.createDataFrame([(None, "u", "same payload")] * 3 + [(4, "u", "x")], "page_id long, url string, html string")
    files = [r.path.removeprefix("file:") for r in warc.write(warc.records(pages, "page_id", "url", "html")).collect()]
    ids = [m for f in files for m in re.findall(rb"WARC-Record-ID: (\S+)", gzip.open(f).read())]
    assert len(set(ids)) == 4 and b"<urn:record:4>" in ids


def test_a_damaged_archive_is_told(spark, tmp_path):
    import gzip

    pages = spark.createDataFrame([(1, "u", "payload " * 50)], "page_id long, url string, html string")
    path = warc.write(warc.records(pages, "page_id", "url", "html")).first().path.removeprefix("file:")
    data = gzip.open(path).read().replace(b"payload", b"PAYLOAD", 1)
    bad = tmp_path / "bad.warc.gz"
    bad.write_bytes(gzip.compress(data))
    manifest = spark.createDataFrame([(f"file://{bad}", 1, 1)], warc.MANIFEST)
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read(manifest).collect()


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write(warc.records(pages, "page_id", "url", "html"))
    assert manifest.isEmpty() and warc.read(manifest).isEmpty()
