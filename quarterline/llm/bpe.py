"""BPE encoding and decoding of text columns by a segment tree over adjacent pair ranks.

The merges are applied by ``encoding.SegmentTreeWords``: the root of the tree yields the
leftmost merge of the lowest rank, each merge is three point updates, and it ends when no
adjacent pair merges. One narrow pass, nothing is shuffled.

Nulls and empty texts have no ids; their decoded text is empty. Very long texts and words are
encoded whole. Repeated rows give repeated rows. Other columns pass through; a column that has
the name of a result column is replaced by it. An empty table gives an empty one.
"""
from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterline.llm.encoding import SegmentTreeWords, byte_characters, encoder, read_tokenizer


def default_tokenizer() -> str:
    """Place of the byte-level vocabulary; the queries' default, a parameter everywhere."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Decoder:
    """Ids back to text, special tokens included."""

    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        byte = {c: b for b, c in enumerate(byte_characters())}
        tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.decimal = [str(i) for i in range(len(self.bytes))]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_DECODERS: dict[int, Decoder] = {}


def decoder(tokenizer_json: str) -> Decoder:
    key = hash(tokenizer_json)
    if key not in _DECODERS:
        _DECODERS[key] = Decoder(tokenizer_json)
    return _DECODERS[key]


def _per_text(df: DataFrame, text: str, tokenizer_path: str, fields: list[tuple[str, T.DataType]], make) -> DataFrame:
    """Add the columns ``fields``, made from a text's ids by ``make(tokenizer_json, ids)``."""
    told = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    names = [n for n, _ in fields]
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([f for f in df.schema.fields if f.name in kept] + [T.StructField(n, t) for n, t in fields])
    arrow_fields = [pa.field(n, {"bigint": pa.int64(), "string": pa.string()}.get(t.simpleString(), pa.list_(pa.int32()))) for n, t in fields]

    def run(batches):
        spec = told.value
        enc = encoder(spec, SegmentTreeWords)
        for b in batches:
            texts = [t or "" for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            made = [make(spec, np.frombuffer(ids, "<u4")) for ids in enc.encode(texts)]
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            columns += [pa.array([m[i] for m in made], f.type) for i, f in enumerate(arrow_fields)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return df.select(*kept, *[F.col(text)] * (text not in kept)).mapInArrow(run, schema)


def encode(df: DataFrame, text: str, tokenizer_path: str, into: str = "ids") -> DataFrame:
    """Add each text's ids as an array of integers."""
    return _per_text(df, text, tokenizer_path, [(into, T.ArrayType(T.IntegerType()))], lambda _, ids: (ids.tolist(),))


def decode(df: DataFrame, ids: str, tokenizer_path: str, into: str = "decoded") -> DataFrame:
    """Add the text that an array of ids stands for. A null array gives an empty text, an id
    outside the vocabulary ends the job with an error."""
    told = df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    @F.pandas_udf(T.StringType())
    def text_of(arrays):
        dec = decoder(told.value)
        return arrays.map(lambda a: dec.decode([] if a is None else list(a)))

    return df.withColumn(into, text_of(F.col(ids)))


def round_trip_digests(df: DataFrame, text: str, tokenizer_path: str) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` (decimal ids joined by commas) and ``decoded_sha256``
    (the text decoded from the ids), without carrying ids or texts on."""

    def digests(spec: str, ids: np.ndarray):
        dec, own = decoder(spec), ids.tolist()
        joined = ",".join(map(dec.decimal.__getitem__, own))
        return len(own), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(dec.decode(own).encode()).hexdigest()

    return _per_text(df, text, tokenizer_path, [
        ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())], digests)
