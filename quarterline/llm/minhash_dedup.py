"""Near duplicates by fast similarity sketches, banding and exact verification.

Sketch: in each of ``T`` rounds every shingle goes to one hashed bin, and bins still empty keep
the smallest value that came; ``T`` more rounds fill one bin each with certainty. A coordinate
of two sketches agrees with the chance of the sets' Jaccard similarity. Large sets are done
after a round or two.

Candidates: sets that are equal are one class from the start. Classes that share one of ``BANDS``
bands of ``ROWS`` coordinates are candidates; a pair at 0.85 shares none with a chance of 6e-11
(at 0.8: 5e-8). A bucket is never paired up. Its member that shares the most with others is its
hub, and members are compared with their hubs. What the hubs connect needs no comparing any
more; of the rest, members of buckets where several components meet are joined on the rarest
shingles that they would have to share to reach the threshold (``_rest``), and those pairs are
compared in full. So no link between different texts is lost, a group of near copies of any size costs
about one comparison for each member and band, and a family whose members are too unlike to be
linked costs no pairs.

Nulls and texts without words have no shingles and are linked with nothing; a null id likewise,
its component is null and it is kept. Repeated rows are one document. Rows of one id with
different texts count as one document that has all their links. Very long texts are read
whole. Other columns, whatever their names, are not touched. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm.graph import components
from quarterline.llm.words import U, mix, randoms, shingles, word_hashes
from quarterline.plans.lineage import materialise

T = 128  # coordinates
ROWS, BANDS = 4, 32
RATIO = 1.02  # of neighbouring classes of set sizes
ROUND = randoms(2 * T, 11)
EMPTY = U(0xFFFFFFFFFFFFFFFF)

SKETCH = "id long, n long, digest binary, bands array<long>"


def sketches(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sketches of sets that stand one after the other; rows of ``T`` coordinates."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    out = np.full((n, T), EMPTY, np.uint64)
    members = sets
    for r in range(2 * T):
        if not len(members):
            break
        h = mix(members ^ ROUND[r])
        if r < T:
            place = owner * T + (h & U(T - 1)).astype(np.int64)
        else:
            place = owner * T + (r - T)
        came = np.full(n * T, EMPTY, np.uint64)
        np.minimum.at(came, place, h >> U(8) | U(r % 256) << U(56))
        came = came.reshape(n, T)
        free = out == EMPTY
        out[free] = came[free]
        open_ = (out == EMPTY).any(1)
        stay = open_[owner]
        members, owner = members[stay], owner[stay]
    return out


def _band_keys(sketch: np.ndarray) -> np.ndarray:
    rows = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.tile(randoms(BANDS, 23), (len(sketch), 1))
    for k in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + rows[..., k])
    return key.view(np.int64)


def _sketch_table(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for b in batches:
            ids = b.column(0)
            texts = [t or b"" for t in b.column(1).to_pylist()]
            at = 0
            for found, words in word_hashes(texts):
                sets, counts = shingles(found, words, width)
                keys = _band_keys(sketches(sets, counts))
                ends = np.cumsum(counts)
                digests = [hashlib.blake2b(sets[e - c:e].tobytes(), digest_size=16).digest() for c, e in zip(counts.tolist(), ends.tolist())]
                some = counts > 0
                bands = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(some * BANDS)].astype(np.int32)), pa.array(keys[some].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(counts)), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), bands],
                    ["id", "n", "digest", "bands"])
                at += len(counts)

    return docs.mapInArrow(run, SKETCH)


def _set_table(docs: DataFrame, width: int) -> DataFrame:
    """Whole sets as sorted 64-bit integers in one binary value."""
    def run(batches):
        for b in batches:
            ids, texts, at = b.column(0), [t or b"" for t in b.column(1).to_pylist()], 0
            for found, words in word_hashes(texts):
                sets, counts = shingles(found, words, width)
                ends = np.cumsum(counts)
                packed = [sets[e - c:e].tobytes() for c, e in zip(counts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(counts)), pa.array(packed, pa.binary())], ["id", "packed"])
                at += len(counts)

    return docs.mapInArrow(run, "id long, packed binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    def run(batches):
        for b in batches:
            x, y = b.column(2), b.column(3)
            keep = []
            for i in range(b.num_rows):
                p, q = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                small, large = (p, q) if len(p) < len(q) else (q, p)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("id").alias("a"), F.col("packed").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("packed").alias("y"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a long, b long")


def _several(rows: DataFrame) -> DataFrame:
    """The rows of buckets where several components meet."""
    several = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    return rows.join(several, "key", "left_semi")


def _size_class(n):
    """Geometric classes of set sizes."""
    return F.floor(F.log(n) / math.log(RATIO)).cast("int")


def _rest(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs across components that may reach the threshold, by the rarest shingles they share.

    What two members of different components share are shingles that several components have. Two
    sets that reach the threshold share at least percent / (100 + percent) of their sizes' sum; so of
    a member's x such shingles, the rarest first, one of the first x + 1 less that many is among the
    partner's first ones as well. The sum is taken from classes of the partner's size, each a key of
    its own with the shingle: texts of one family that are too unlike to be linked have no such
    shingles left for partners of their size, and no pairs are made of them."""
    own = mixed.select("id", "component", "n").distinct()
    listed = own.join(sets, "id")

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                s = np.frombuffer(b.column(3)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), b.column(k)[i].as_py())) for k in range(3)] + [pa.array(s)], ["id", "component", "n", "s"])

    rows = listed.select("id", "component", "n", "packed").mapInArrow(run, "id long, component long, n long, s long")
    shared = rows.groupBy("s").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("f")).where("x <> y").select("s", "f")
    of_id = Window.partitionBy("id")
    ranked = rows.join(shared, "s").withColumn("x", F.count("*").over(of_id)).withColumn("rank", F.row_number().over(of_id.orderBy("f", "s")))
    n, x = F.col("n"), F.col("x")
    # with the smallest partner there can be
    ranked = materialise(ranked.where(F.col("rank") <= x + 1 - F.ceil(n * percent / 100)).select("id", "component", "n", "x", "rank", "s"), "rare_shingles")

    def reached(c):  # partners of class c have this many shingles at least
        return F.greatest(F.floor(F.pow(F.lit(RATIO), c)) - 1, F.lit(0))

    def classes(low, high):
        return F.explode(F.filter(F.sequence(low, high), lambda c: F.col("rank") <= x + 1 - F.ceil((n + reached(c)) * percent / (100 + percent))))

    mine = _size_class(n)
    larger = ranked.select("s", mine.alias("large"), classes(_size_class(F.greatest(F.floor(n * percent / 100) - 1, F.lit(1))), mine).alias("small"),
                           F.col("id").alias("a"), F.col("component").alias("component_a"), n.alias("n_a"))
    smaller = ranked.select("s", classes(mine, _size_class(F.ceil(n * 100 / percent) + 1)).alias("large"), mine.alias("small"),
                            F.col("id").alias("b"), F.col("component").alias("component_b"), n.alias("n_b"))
    in_order = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") > F.col("b")))
    met = larger.join(smaller, ["s", "large", "small"]).where(in_order & (F.col("component_a") != F.col("component_b")) & (F.col("n_b") * 100 >= F.col("n_a") * percent))
    return met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def links(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The stored sketches, and ``id`` and ``component`` of all that is linked with another."""
    docs = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    sketch = materialise(_sketch_table(docs, width), "sketches")
    filled = sketch.where("n > 0")
    firsts = filled.groupBy("digest").agg(F.min("id").alias("first_id"))
    equal = filled.join(firsts, "digest").where("id <> first_id").select(F.col("id").alias("a"), F.col("first_id").alias("b"))
    classes = filled.join(firsts.select("digest", F.col("first_id").alias("id")), ["digest", "id"], "left_semi")
    rows = classes.select("id", "n", F.explode("bands").alias("key")).distinct()
    crowd = rows.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    buckets = materialise(rows.join(crowd, "key"), "buckets")
    near = buckets.select("id").distinct()
    sets = materialise(_set_table(docs.join(near, "id", "left_semi"), width).distinct(), "shingle_sets")

    # each bucket's hub is the member that shares most buckets with most others
    degree = buckets.groupBy("id").agg(F.sum("crowd").alias("degree"))
    placed = buckets.join(degree, "id")
    hub = placed.groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("x"), "n")).alias("hub"))

    def close(a, b):
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    pairs = placed.join(hub, "key").where((F.col("id") != -F.col("hub.x")) & close(F.col("n"), F.col("hub.n"))).select(
        F.greatest("id", -F.col("hub.x")).alias("a"), F.least("id", -F.col("hub.x")).alias("b")).distinct()
    linked = materialise(_verified(pairs, sets, percent), "links")
    found = materialise(components(linked), "components")

    # what hubs did not connect: compared across components
    placed = buckets.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("component"))
    rest = _rest(materialise(_several(placed), "mixed"), sets, percent)
    more = materialise(_verified(rest, sets, percent), "more_links")
    edges = linked.unionByName(more).unionByName(equal)
    return sketch, materialise(components(edges), "components")


def near_duplicates(docs: DataFrame, doc_id: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of each document: link where
    100 * intersection >= ``percent`` * union of the distinct runs of ``width`` words."""
    sketch, found = links(docs, doc_id, text, width, percent)
    rows = sketch.join(found, "id", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
    rows = rows.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = docs.where(F.col(doc_id).isNull()).select(F.lit(None).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    return rows.unionByName(_sketch_table(nameless, width).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def drop_near_duplicates(docs: DataFrame, doc_id: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, null ids last.

    Rows are told apart by their texts, whatever their ids: of rows of one text one stays, so
    nothing goes because another row has its id, and copies without ids go as others do. Of equal ids
    the smallest text's digest goes first, of rows of one id and text that with the smallest other
    columns. Texts without words are no copies of each other; all their rows stay."""
    names, others = docs.columns, [c for c in docs.columns if c not in (doc_id, text)]
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    marked = docs.withColumn("__digest", digest)
    blank = F.coalesce(F.trim(F.translate(F.col(text), "\t\n\x0b\f\r", "     ")), F.lit("")) == ""
    first = F.struct(F.col(doc_id).isNull(), F.col(doc_id), *[F.struct(F.col(c).isNull(), F.col(c)) for c in others])
    # copies meet as partial aggregates: what travels is one row a text and map task
    one = marked.where(~blank).groupBy("__digest").agg(F.min_by(F.struct(*[F.col(c) for c in names]), first).alias("__row"))
    one = materialise(one.select("__digest", F.conv(F.substring("__digest", 1, 15), 16, 10).cast("long").alias("__key"), F.col(f"__row.`{doc_id}`").alias("__id"), "__row"), "distinct_texts")
    _, found = links(one.select("__key", F.col(f"__row.`{text}`").alias("__text")), "__key", "__text", width, percent)
    grouped = one.select("__key", "__digest", "__id").join(found.select(F.col("id").alias("__key"), "component"), "__key")
    winner = grouped.groupBy("component").agg(F.min(F.struct(F.col("__id").isNull().alias("x"), "__id", "__digest")).alias("w")).select(F.col("w.__digest").alias("__digest"))
    gone = grouped.select("__digest").join(winner, "__digest", "left_anti")
    return one.join(gone, "__digest", "left_anti").select("__row.*").select(*names).unionByName(docs.where(blank))
