"""WARC archives written from and read back into a chunked record table.

A payload travels as rows of record id and chunk number, each with the SHA-256 of all bytes up
to its end, so that the last chunk's digest is the payload's and a reader can check as it goes.
No task holds more than one chunk of a payload beside the row it came in. Of records with equal
payloads of ``least`` bytes or more, the one with the smallest id is the response and the others
are revisits that name it; the choice is made on digests, the payloads are never grouped.

Files are gzip, one member for each record, and get names of their own; the manifest, a written
table, lists those that count. A lost executor's files are therefore never read.

A null payload counts as empty. A row without id is archived under a record id made up for it, a
random urn:uuid, and is read back with a null id; it is never the response that others name, and
revisits one that has an id. Records of one id and equal payloads are all kept; the first id being
equal, all of them are responses. Very long payloads are cut into chunks. Other columns are not
read. An empty table gives no archive and no rows.
"""
from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.plans.lineage import materialise, new_path

CHUNK = 1 << 20
FILE_BYTES = 256 << 20
LEVEL = 1  # of gzip
EMPTY = hashlib.sha256(b"").hexdigest()

CHUNKS = ("record_id long, record_type string, refers_to long, uri string, chunk_no int, chunk binary, "
          "digest string, payload_bytes long, payload_digest string")
MANIFEST = "path string, records long, bytes long"


def records(pages: DataFrame, record_id: str, uri: str, payload: str, least: int = 100) -> DataFrame:
    """``record_id``, ``uri``, ``payload``, ``payload_digest``, ``record_type`` and ``refers_to``."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(record_id).cast("long").alias("record_id"), F.col(uri).cast("string").alias("uri"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"))
    first = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(
        F.min("record_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL")
    again = rows.select("record_id", "digest").join(first.select("digest", "first_id"), "digest").where(
        "record_id IS NULL OR record_id <> first_id").select("record_id", "digest", "first_id").distinct().select(
        F.col("record_id").alias("again_id"), F.col("digest").alias("again_digest"), "first_id")
    same = F.col("record_id").eqNullSafe(F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    return rows.join(again, same, "left").select(
        "record_id", "uri", "payload", F.col("digest").alias("payload_digest"), F.when(F.col("first_id").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("first_id").alias("refers_to"))


def _head(record_id: int | None, uri: str, kind: str, refers: int | None, digest: str, size: int) -> bytes:
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{f'uuid:{uuid.uuid4()}' if record_id is None else f'record:{record_id}'}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:record:{refers}>"]
    lines += ["Content-Type: application/octet-stream", f"Content-Length: {size if kind == 'response' else 0}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def chunk_table(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``records`` as rows of record id and chunk number, in order within each record."""
    def run(batches):
        out = _Rows(4 * chunk)
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            ids, kinds, refers, uris, digests = (col[n].to_pylist() for n in ("record_id", "record_type", "refers_to", "uri", "payload_digest"))
            for i, record_id in enumerate(ids):
                body = memoryview(col["payload"][i].as_buffer())
                running = hashlib.sha256()
                for no, at in enumerate(range(0, max(len(body), 1), chunk)):
                    piece = body[at:at + chunk]
                    running.update(piece)
                    yield from out.add((record_id, kinds[i], refers[i], uris[i], no, bytes(piece), running.hexdigest(), len(body), digests[i]))
        yield from out.rest()
    return rows.mapInArrow(run, CHUNKS)


_TYPES = pa.schema([
    ("record_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("uri", pa.string()),
    ("chunk_no", pa.int32()), ("chunk", pa.binary()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


class _Rows:
    """Gathers chunk rows to batches of bounded size."""

    def __init__(self, most: int):
        self.most, self.rows, self.size = most, [], 0

    def add(self, row: tuple):
        self.rows.append(row)
        self.size += len(row[5])
        if self.size >= self.most or len(self.rows) >= 4096:
            yield from self.rest()

    def rest(self):
        if self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), _TYPES.types)], _TYPES.names)
            self.rows, self.size = [], 0


class _Archive:
    """One file of gzip members, fed with chunk rows."""

    def __init__(self, store, folder: str, inner: str):
        name = f"{uuid.uuid4().hex}.warc.gz"
        self.path, self.records, self.bytes = f"{folder}/{name}", 0, 0
        self.stream = store.open_output_stream(f"{inner}/{name}", compression=None)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def add(self, record_id, kind, refers, uri, no, piece, digest, size, payload_digest, last: bool) -> None:
        parts = []
        if no == 0:
            self.member, self.records = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), self.records + 1
            uri = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
            parts.append(self.member.compress(_head(record_id, uri, kind, refers, payload_digest, size)))
        if kind == "response":
            parts.append(self.member.compress(piece))
        if last:
            if digest != payload_digest:
                raise ValueError(f"the chunks of record {record_id} do not have its digest")
            parts.append(self.member.compress(b"\r\n\r\n") + self.member.flush())
        self._put(b"".join(parts))

    def close(self) -> pa.RecordBatch:
        self.stream.close()
        return pa.RecordBatch.from_pydict({"path": [self.path], "records": pa.array([self.records], pa.int64()), "bytes": pa.array([self.bytes], pa.int64())})


def write(rows: DataFrame, folder: str | None = None, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``records`` as archives, by way of their chunk table; returns the stored manifest."""
    folder = folder or new_path(rows.sparkSession, "warc")

    def run(batches):
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)
        out, done = None, 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                out = out or _Archive(store, folder, inner)
                done += len(row[5])
                last = done == row[7]
                out.add(*row, last)
                if last:
                    done = 0
                    if out.bytes >= file_bytes:
                        yield out.close()
                        out = None
        if out is not None:
            yield out.close()

    return materialise(chunk_table(rows, chunk).mapInArrow(run, MANIFEST), "warc_manifest")


class _Member:
    """The bytes of a file of gzip members, as one stream read piece by piece."""

    def __init__(self, stream, chunk: int):
        self.stream, self.chunk, self.have, self.raw = stream, chunk, bytearray(), b""
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            self.raw = self.inflate.unused_data
            self.inflate = zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.stream.read(self.chunk)
            if not self.raw:
                return False
        data = self.inflate.decompress(self.raw, self.chunk)
        self.raw = b"" if self.inflate.eof else self.inflate.unconsumed_tail
        self.have += data
        return True

    def until(self, mark: bytes) -> bytes | None:
        at = -1
        while (at := self.have.find(mark)) < 0:
            if not self._more():
                return None
        found = bytes(self.have[:at])
        del self.have[:at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self._more():
                raise EOFError("the archive ends within a record")
        found = bytes(self.have[:n])
        del self.have[:n]
        return found


def _read_file(path: str, chunk: int):
    """The chunk rows of one archive, each record's digest checked."""
    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_stream(inner, compression=None) as stream:
        source = _Member(stream, chunk)
        while (head := source.until(b"\r\n\r\n")) is not None:
            version, *lines = head.decode().split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"{path}: no record where one should start")
            field = dict(line.split(": ", 1) for line in lines)
            number = lambda name: int(field[name][12:-1]) if field.get(name, "").startswith("<urn:record:") else None
            size, digest = int(field["Content-Length"]), field["WARC-Payload-Digest"].removeprefix("sha256:")
            base = (number("WARC-Record-ID"), field["WARC-Type"], number("WARC-Refers-To"), field["WARC-Target-URI"])
            whole = int(field["WARC-Payload-Length"])
            if base[1] == "revisit":  # nothing but the head
                yield (*base, 0, b"", digest, whole, digest), True
            else:
                running, left, no = hashlib.sha256(), size, 0
                while True:
                    piece = source.take(min(chunk, left))
                    running.update(piece)
                    left -= len(piece)
                    if not left and running.hexdigest() != digest:
                        raise ValueError(f"{path}: record {base[0]} does not have its digest")
                    yield (*base, no, piece, running.hexdigest(), whole, digest), not left
                    no += 1
                    if not left:
                        break
            if source.take(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: record {base[0]} is not closed")


def read(manifest: DataFrame, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """The chunk table of the archives, one task for each file. Without ``payload`` the chunks
    are read and checked but stay behind, and each record leaves its last row only."""
    files = max(1, manifest.count())  # a row for each file

    def run(batches):
        out = _Rows(4 * chunk)
        for b in batches:
            for path in b.column(0).to_pylist():
                for row, last in _read_file(path, chunk):
                    if payload:
                        yield from out.add(row)
                    elif last:
                        yield from out.add((*row[:5], b"", *row[6:]))
        yield from out.rest()

    return manifest.select("path").repartition(files).mapInArrow(run, CHUNKS)
