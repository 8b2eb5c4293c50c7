"""Token ids of documents in binary files, in ascending order of document ids.

A file holds patched frame-of-reference blocks (``pfor``), then the starts of the blocks, then
the documents' ids and token counts, then a footer. Documents are dealt out by ranges of their
ids, so that one range is one run of files; each task encodes and writes as it reads, and hands
on one row for a file. Only files named in that written manifest are ever read: what a lost
executor left half done is never seen.

Nulls and empty texts hold the end id alone. Rows of one document id stay apart, ordered by
text; a null id comes first. Very long texts are written whole. Other columns are not read. An
empty table gives no file and no rows.
"""
from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.encoding import LibraryWords, encoder, read_tokenizer
from quarterline.llm.pfor import BLOCK, pack_blocks, unpack_block
from quarterline.plans.lineage import materialise, new_path

MAGIC = b"QLTOK001"
FOOTER = struct.Struct("<QQQQ8s")  # documents, values, blocks, place of the index, magic
FLUSH = 64 * BLOCK
FILE_VALUES = 64 << 20
NO_ID = -(1 << 63)  # stands for a null document id in a file

MANIFEST = "part int, file int, path string, documents long, tokens long"


class _Writer:
    def __init__(self, stream, percentile: float):
        self.stream, self.percentile = stream, percentile
        self.at = self.values = self.waiting_values = 0
        self.waiting: list[bytes] = []
        self.starts: list[int] = []
        self.ids: list[int] = []
        self.counts: list[int] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(NO_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        self.waiting.append(ids)
        self.waiting_values += len(ids) // 4
        if self.waiting_values >= FLUSH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        values = np.frombuffer(b"".join(self.waiting), "<u4")
        cut = len(values) if last else len(values) // BLOCK * BLOCK
        for block in pack_blocks(values[:cut], self.percentile):
            self.starts.append(self.at)
            self._put(block)
        self.values += cut
        self.waiting, self.waiting_values = [values[cut:].tobytes()], len(values) - cut

    def close(self) -> None:
        self._flush(True)
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array(self.ids, "<i8").tobytes())
        self._put(np.array(self.counts, "<u8").tobytes())
        self._put(FOOTER.pack(len(self.ids), self.values, len(self.starts), index, MAGIC))
        self.stream.close()


class TokenFile:
    """Reads a file by its index; blocks are read as they are needed."""

    def __init__(self, path: str):
        store, inner = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(inner)
        size = self.file.size()
        documents, self.values, blocks, index, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self.file.read_at(size - FOOTER.size - index, index)
        self.starts = np.append(np.frombuffer(raw, "<u8", blocks), index).astype(np.int64)
        self.ids = np.frombuffer(raw, "<i8", documents, 8 * blocks)
        self.counts = np.frombuffer(raw, "<u8", documents, 8 * (blocks + documents)).astype(np.int64)
        self.ends = np.cumsum(self.counts)

    def block(self, i: int) -> np.ndarray:
        a, b = self.starts[i:i + 2].tolist()
        return unpack_block(self.file.read_at(b - a, a))

    def tokens(self, document: int) -> np.ndarray:
        """The ids of one document of the file, by its place in it."""
        end = int(self.ends[document])
        start = end - int(self.counts[document])
        found = [self.block(i) for i in range(start // BLOCK, -(-end // BLOCK))]
        at = start // BLOCK * BLOCK
        return np.concatenate(found)[start - at:end - at]

    def documents(self):
        """Document ids, starts in the file and ids of all documents; one pass over the blocks."""
        blocks, start = iter(range(len(self.starts) - 1)), 0
        have = np.empty(0, np.uint32)
        for doc_id, count in zip(self.ids.tolist(), self.counts.tolist()):
            if len(have) < count:
                parts, size = [have], len(have)
                while size < count:
                    parts.append(self.block(next(blocks)))
                    size += len(parts[-1])
                have = np.concatenate(parts)
            yield None if doc_id == NO_ID else doc_id, start, have[:count]
            have, start = have[count:], start + count


def write(docs: DataFrame, doc_id: str, text: str, tokenizer_path: str, end_id: int, folder: str | None = None,
          percentile: float = 0.98, file_values: int = FILE_VALUES) -> DataFrame:
    """Encode and write all texts; returns the stored manifest, one row for each file."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    told = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    end = struct.pack("<I", end_id)

    def run(batches):
        enc, part = encoder(told.value, LibraryWords), TaskContext.get().partitionId()
        store, inner = fs.FileSystem.from_uri(folder)
        store.create_dir(inner, recursive=True)
        writer, name, file = None, "", 0

        def row():
            writer.close()
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": pa.array([file], pa.int32()), "path": [f"{folder}/{name}"],
                "documents": pa.array([len(writer.ids)], pa.int64()), "tokens": pa.array([writer.values], pa.int64())})

        for b in batches:
            ids = b.column(0).to_pylist()
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, tokens in zip(ids, enc.encode(texts)):
                if writer is None:
                    name = f"{part:06d}-{file:04d}-{uuid.uuid4().hex}.tok"
                    writer = _Writer(store.open_output_stream(f"{inner}/{name}"), percentile)
                writer.add(i, tokens + end)
                if writer.values >= file_values:
                    yield row()
                    writer, file = None, file + 1
        if writer is not None:
            yield row()

    # many rows of one id, or without one, are several ranges: they go on by how their texts begin
    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = dealt.repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    return materialise(dealt.mapInArrow(run, MANIFEST), "token_manifest")


def _per_document(manifest: DataFrame, schema: str, make) -> DataFrame:
    order = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = max(1, manifest.count())  # a row for each file
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(order), F.lit(0))).repartition(files)
    typed = pa.schema([(f.split()[0], {"long": pa.int64(), "ids": pa.list_(pa.int32())}[f.split()[1]]) for f in schema.split(", ")])

    def run(batches):
        for b in batches:
            for path, base in zip(b.column("path").to_pylist(), b.column("base").to_pylist()):
                rows: list[tuple] = []
                size = 0
                for doc_id, start, ids in TokenFile(path).documents():
                    rows.append((doc_id, base + start, *make(ids)))
                    size += len(ids)
                    if len(rows) >= 4096 or size >= 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), typed.types)], typed.names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), typed.types)], typed.names)

    return based.mapInArrow(run, schema.replace("ids ids", "ids array<int>"))


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before it) and ``ids``, from the files."""
    return _per_document(manifest, "doc_id long, start long, ids ids", lambda ids: (ids.astype(np.int32).tolist(),))


def read_checksums(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the ids' crc32, from the files."""
    return _per_document(manifest, "doc_id long, start long, n_tokens long, ids_crc32 long",
                         lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
