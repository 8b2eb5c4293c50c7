"""Removal of repeated byte strings, by bucket-pointer refinement of suffixes.

A suffix counts by its first ``length`` bytes. Suffixes are not all sorted: from every window of
``length`` bytes the smallest hashed ``q``-gram is chosen (the leftmost, if several are), which
equal windows choose alike. So equal windows lie around equal chosen q-grams, and only suffixes
near a q-gram that is chosen in two places can repeat.

Those q-grams are the initial buckets. In a bucket, suffixes get the bucket of their first
``q`` bytes as a pointer; buckets are refined by sorting on the pointers at later offsets, first
``q`` bytes on, then, with the pointers just made, at the offset that completes the window.
Buckets of one are dropped at every turn. Buckets meet in tasks by runs of ``REFINED``
suffix groups; one over ``TOGETHER`` (a passage that very many texts share) is refined by grouping on
hashes instead: by what all windows of a range of offsets have in common, then window by window,
so that no bucket is ever collected.

Texts that are equal are one text that is repeated as a whole. Within one text, windows that
repeat are found at once. Hashes have 64 bits of independent polynomials at each step, numbers of
texts 60 bits: among a billion texts about one pair in two such corpora would share a number, and
repeats of one of the two could then be missed.

Nulls count as empty. Texts shorter than ``length`` lose nothing. Very long texts are read in
slices that overlap by a window. Repeated rows are copies of each other, whatever their ids. Other columns are
not read. An empty table gives no rows.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.words import INVERSE, POWER, U, mix, randoms
from quarterline.plans.lineage import materialise

LENGTH = 400
TOGETHER = 4096
REFINED = 512  # suffix groups after which a task refines what it has
SLICE = 1 << 17  # bytes looked at together: some twenty arrays of 8 bytes for each
STEP = 16  # offsets of a range in large buckets
KNOWN_TEXTS = 1_000_000  # texts of a task remembered to skip its copies
CODES = randoms(256, 101)
OTHER = randoms(256, 211)
LOW = U(SLICE - 1)


def _total(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums along the last axis."""
    out = np.zeros((*data.shape[:-1], data.shape[-1] + 1), np.uint64)
    np.cumsum(codes[data] * POWER[:data.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _grams(total: np.ndarray, width: int) -> np.ndarray:
    n = total.shape[-1] - width
    return mix((total[..., width:] - total[..., :n]) * INVERSE[:n])


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width``, by minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, ~U(0))
    padded[:len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _runs(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal intervals that windows at sorted places cover."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return list(zip(at[np.r_[0, cut + 1]].tolist(), (at[np.r_[cut, len(at) - 1]] + length).tolist()))


def _chosen(data: np.ndarray, bounds: np.ndarray, q: int, length: int):
    """Chosen q-grams of texts in at most ``SLICE`` bytes: hash, place, and how far before it the
    nearest and the farthest window that choose it begin; and the intervals that repeat within a
    text, by text. ``bounds``: starts of the texts and the end, a byte between."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none.view(np.uint64), none, none, none, []
    total = _total(data, CODES)
    grams = _grams(total, q)
    keys = grams & ~LOW | np.arange(len(grams), dtype=np.uint64)
    place = (_smallest(keys, length - q + 1) & LOW).astype(np.int64)
    start = np.arange(len(place))
    text = np.searchsorted(bounds, start, side="right") - 1
    ok = start + length <= bounds[text + 1] - 1
    start, place, text = start[ok], place[ok], text[ok]
    first = np.r_[True, (place[1:] != place[:-1])] if len(place) else np.zeros(0, bool)
    spots, owner = place[first], text[first]
    # texts that choose one q-gram twice may repeat themselves
    order = np.lexsort((grams[spots], owner))
    twice = (owner[order][1:] == owner[order][:-1]) & (grams[spots][order][1:] == grams[spots][order][:-1])
    local, keep = [], np.ones(len(start), bool)
    for t in np.unique(owner[order][1:][twice]).tolist():
        own = np.flatnonzero(text == t)
        s = start[own]
        h = mix((total[s + length] - total[s]) * INVERSE[s])
        _, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        local += [(t, a, b) for a, b in _runs(s[n[back] > 1], length)]
        again = np.ones(len(own), bool)
        again[at] = False
        keep[own[again]] = False
    start, place = start[keep], place[keep]
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.empty(0, np.int64)
    last = np.r_[new[1:], len(place)] - 1 if len(new) else new
    spots = place[new]
    return grams[spots], spots, spots - start[last], spots - start[new], local


SPOT = "gram long, text long, place long, low long, high long"


def _anchors(docs: DataFrame, q: int, length: int) -> DataFrame:
    """``gram``, ``text`` (a number of the text), ``place``, and in ``low`` and ``high`` how far
    before it the windows begin that choose it. With a null gram, an interval that repeats within
    the text, from ``low`` to ``high``."""
    def rows(gram, *columns):
        n = len(columns[0])
        first = pa.nulls(n, pa.int64()) if gram is None else pa.array(gram.view(np.int64))
        return pa.RecordBatch.from_arrays([first, *(pa.array(c, pa.int64()) for c in columns)], [f.split()[0] for f in SPOT.split(", ")])

    def run(batches):
        known: set[int] = set()
        for b in batches:
            todo = []
            for t, body in zip(b.column(0).to_pylist(), b.column(1)):
                if t not in known and (body := body.as_buffer()).size >= length:
                    known.add(t)
                    todo.append((t, memoryview(body)))
            if len(known) > KNOWN_TEXTS:
                known.clear()
            at = 0
            while at < len(todo):
                t, body = todo[at]
                if len(body) > SLICE:
                    data = np.frombuffer(body, np.uint8)
                    for cut in range(0, len(data) - length + 1, SLICE - length + 1):
                        part = data[cut:cut + SLICE]
                        gram, place, low, high, local = _chosen(part, np.array([0, len(part) + 1]), q, length)
                        yield rows(gram, np.full(len(place), t), place + cut, low, high)
                        yield rows(None, [t] * len(local), [0] * len(local), [a + cut for _, a, _ in local], [e + cut for _, _, e in local])
                    at += 1
                    continue
                end, size = at, 0
                while end < len(todo) and size + len(todo[end][1]) < SLICE:
                    size += len(todo[end][1]) + 1
                    end += 1
                end = max(end, at + 1)
                bounds = np.cumsum([0, *(len(x) + 1 for _, x in todo[at:end])])
                data = np.frombuffer(b"\0".join(x for _, x in todo[at:end]), np.uint8)
                gram, place, low, high, local = _chosen(data, bounds, q, length)
                owner = np.searchsorted(bounds, place, side="right") - 1
                names = np.array([t for t, _ in todo[at:end]], np.int64)
                yield rows(gram, names[owner], place - bounds[owner], low, high)
                yield rows(None, [int(names[t]) for t, _, _ in local], [0] * len(local),
                           [int(a - bounds[t]) for t, a, _ in local], [int(e - bounds[t]) for t, _, e in local])
                at = end

    return docs.select("text", "body").mapInArrow(run, SPOT)


def _contexts(affected: DataFrame, q: int, length: int) -> DataFrame:
    """The bytes of all windows that choose a q-gram, from ``high`` before it on."""
    def run(batches):
        for b in batches:
            for t, body, spots in zip(*(b.column(i).to_pylist() for i in range(3))):
                for k in range(0, len(spots or ()), 2048):
                    own = spots[k:k + 2048]
                    columns = [[x[f] for x in own] for f in ("gram", "place", "low", "high")]
                    parts = [body[p - high:p - low + length] for _, p, low, high in zip(*columns)]
                    gram, place, low, high = (pa.array(c, pa.int64()) for c in columns)
                    yield pa.RecordBatch.from_arrays(
                        [gram, pa.array([t] * len(own), pa.int64()), place, low, high, pa.array(parts, pa.binary())],
                        ["gram", "text", "place", "low", "high", "context"])

    return affected.select("text", "body", "spots").mapInArrow(run, SPOT + ", context binary")


def _numbered(keys: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the open suffixes by their keys, and which suffixes are not alone in theirs."""
    out = np.zeros(keys.shape, np.uint64)
    stay = np.zeros(keys.shape, bool)
    own = keys[free]
    if len(own):
        _, back, n = np.unique(own, return_inverse=True, return_counts=True)
        out[free] = back
        stay[free] = n[back] > 1
    return out, stay


def _refined(contexts: list[bytes], left: np.ndarray, q: int, length: int) -> np.ndarray:
    """Which windows repeat: rows of contexts, columns of places from ``reach`` before the q-gram.
    ``left``: the bytes of each context before its q-gram."""
    reach = length - q
    wide = 2 * reach + q
    data = np.zeros((len(contexts), wide), np.uint8)
    shift = reach - left
    size = np.fromiter(map(len, contexts), np.int64, len(contexts))
    column = np.arange(wide)
    data[(column >= shift[:, None]) & (column < (shift + size)[:, None])] = np.frombuffer(b"".join(contexts), np.uint8)
    offset = np.arange(reach + 1)
    valid = (offset >= shift[:, None]) & (offset + length <= (shift + size)[:, None])
    n = wide - q + 1
    total = _total(data, OTHER)
    used = np.zeros((len(contexts), n), bool)  # suffixes that windows point to
    for step in (0, q, length - 2 * q, length - q):
        used[:, step:step + reach + 1] |= valid
    one, stay = _numbered(_grams(total, q), used)
    # 2q bytes: pointers q on
    m = n - q
    pair = one[:, :m] << U(32) | one[:, q:]
    two, stay2 = _numbered(pair, stay[:, :m] & stay[:, q:])
    # whole windows: the pointers just made, where the window's last 2q bytes begin
    late = length - 2 * q
    pair = two[:, :reach + 1] << U(32) | two[:, late:late + reach + 1]
    _, repeated = _numbered(pair, valid & stay2[:, :reach + 1] & stay2[:, late:late + reach + 1])
    return repeated


def _intervals(repeated: np.ndarray, text, place, q: int, length: int):
    """Intervals of texts that repeated windows around their q-grams cover."""
    out = []
    for r in np.flatnonzero(repeated.any(1)).tolist():
        at = np.flatnonzero(repeated[r]) + int(place[r]) - (length - q)
        out += [(int(text[r]), a, b) for a, b in _runs(at, length)]
    return out


def _small_buckets(contexts: DataFrame, q: int, length: int) -> DataFrame:
    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["text", "start", "stop"])

    def refine(rows):
        _, text, place, _, high, parts = (list(c) for c in zip(*rows))
        return _intervals(_refined(parts, np.array(high), q, length), text, place, q, length)

    def run(batches):
        have, last = [], None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if len(have) >= REFINED and row[0] != last:
                    if out := refine(have):
                        yield batch(out)
                    have = []
                have.append(row)
                last = row[0]
        if have and (out := refine(have)):
            yield batch(out)

    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "text long, start long, stop long")


def _large_buckets(contexts: DataFrame, q: int, length: int) -> DataFrame:
    """Intervals in buckets of any size, by grouping on hashes only."""
    def hashes(b, what):
        for _, text, place, low, high, part, *more in zip(*(c.to_pylist() for c in b.columns)):
            total = _total(np.frombuffer(part, np.uint8), OTHER)

            def span(a, e, tag=0, total=total):
                h = (total[e:e + 1] - total[a:a + 1]) * INVERSE[a:a + 1]
                return int(mix(mix(h + U(e - a)) + U(tag)).view(np.int64)[0])

            yield from what(text, place, low, high, len(part), span, *more)

    def ranges(text, place, low, high, size, span):
        for r in range(low // STEP, high // STEP + 1):
            first, last = r * STEP, r * STEP + STEP - 1
            core = span(high - first, high - last + length)  # common to all windows of the range
            a, e = max(0, high - last), min(size, high - first + length)
            whole = span(a, e, 1 + (a - (high - last)) * STEP + (high - first + length - e))
            yield text, place, low, high, r, core, whole, max(low, first), min(high, last)

    def windows(text, place, low, high, size, span, r, own_low, own_high):
        for o in range(own_low, own_high + 1):
            yield text, place, o, span(high - o, high - o + length)

    def emit(what, schema):
        names = [f.split()[0] for f in schema.split(", ")]

        def run(batches):
            for b in batches:
                for k in range(0, b.num_rows, 512):
                    rows = list(hashes(b.slice(k, 512), what))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        return run

    # A text in slices has several contexts at one place, where slices meet: own windows, told apart by low and high
    context = ["text", "place", "low", "high"]
    schema = "text long, place long, low long, high long, r long, core long, whole long, own_low long, own_high long"
    columns = ["gram", "text", "place", "low", "high", "context"]
    rows = materialise(contexts.select(*columns).mapInArrow(emit(ranges, schema), schema), "ranges")
    classes = rows.groupBy("core", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*context, "r")).alias("first"))
    several = classes.groupBy("core").agg(F.min("whole").alias("x"), F.max("whole").alias("y")).where("x <> y").select("core")
    covered = rows.join(classes.where("n > 1").select("core", "whole"), ["core", "whole"], "left_semi")
    todo = classes.join(several, "core", "left_semi").select("first.*")
    todo = todo.join(rows, [*context, "r"]).select(*context, "r", "own_low", "own_high").distinct()
    schema = "text long, place long, o long, window long"
    single = materialise(contexts.join(todo, context).select(
        *columns, "r", "own_low", "own_high").mapInArrow(emit(windows, schema), schema), "windows")
    again = single.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    more = single.join(again, "window", "left_semi")
    return covered.selectExpr("text", "place - own_high AS start", f"place - own_low + {length} AS stop").unionByName(
        more.selectExpr("text", "place - o AS start", f"place - o + {length} AS stop"))


def repeated_intervals(docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, together: int = TOGETHER) -> tuple[DataFrame, DataFrame]:
    """All rows (``id``, ``text``, ``sha``, ``n_bytes``, ``n`` copies) as one stored table, and as
    the other each distinct text that has repeated bytes, with ``body``, ``starts`` and ``stops``.
    ``text`` is a number of the text: the first 60 bits of its digest."""
    q = length * 8 // 25  # 3q > length >= 2q, as the refinement's steps need
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sha = F.sha2(body, 256)
    number = F.conv(F.substring(sha, 1, 15), 16, 10).cast("long")
    rows = docs.select(F.col(doc_id).alias("id"), number.alias("text"), sha.alias("sha"), F.octet_length(body).cast("long").alias("n_bytes"))
    rows = materialise(rows, "digests")
    texts = rows.where(F.col("n_bytes") >= length).groupBy("text", "sha").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))
    texts = materialise(texts, "texts")
    anchors = materialise(_anchors(docs.select(number.alias("text"), body.alias("body")), q, length), "anchors")
    spots = anchors.where("gram IS NOT NULL")
    shared = spots.groupBy("gram").agg(*[f("text").alias(f"t_{n}") for f, n in ((F.min, "x"), (F.max, "y"))],
                                       *[f("place").alias(f"p_{n}") for f, n in ((F.min, "x"), (F.max, "y"))])
    shared = shared.where("t_x <> t_y OR p_x <> p_y").select("gram")
    found = spots.join(shared, "gram", "left_semi").groupBy("text").agg(F.collect_set(F.struct("gram", "place", "low", "high")).alias("spots"))  # a text's own
    local = anchors.where("gram IS NULL").select("text").distinct()
    todo = found.join(local, "text", "full").join(texts.select("text", "sha", F.col("first_id").alias("id")), "text")
    source = docs.select(F.col(doc_id).alias("id"), sha.alias("sha"), body.alias("body"))
    affected = materialise(source.join(todo, (source["id"].eqNullSafe(todo["id"])) & (source["sha"] == todo["sha"])).select(
        "text", todo["sha"], "body", "spots"), "affected")
    contexts = materialise(_contexts(affected, q, length), "contexts")
    crowd = contexts.groupBy("gram").count()
    large = materialise(crowd.where(F.col("count") > together).select("gram"), "large")
    parts = [_small_buckets(contexts.join(large, "gram", "left_anti"), q, length),
             anchors.where("gram IS NULL").selectExpr("text", "low AS start", "high AS stop")]
    if not large.isEmpty():
        parts.append(_large_buckets(contexts.join(large, "gram", "left_semi"), q, length))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    listed = union.groupBy("text").agg(F.collect_set(F.struct("start", "stop")).alias("parts"))  # a text's own
    return rows.join(texts.select("text", "sha", "n"), ["text", "sha"], "left"), affected.select("text", "sha", "body").join(listed, "text").select(
        "text", "sha", "body", F.col("parts.start").alias("starts"), F.col("parts.stop").alias("stops"))


def _cut(affected: DataFrame, keep_text: bool) -> DataFrame:
    """What is left of each text: counts and digest, and the text itself if asked for."""
    fields = [("text", pa.int64()), ("sha", pa.string()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    fields += [("kept", pa.binary())] * keep_text

    def run(batches):
        for b in batches:
            for t, sha, body, starts, stops in zip(*(c.to_pylist() for c in b.columns)):
                at, removed, spans, kept, parts = 0, 0, 0, hashlib.sha256(), []
                end = -1
                for a, e in sorted(zip(starts, stops)):
                    if a > end:
                        spans += 1
                        piece = memoryview(body)[max(at, 0):a]
                        kept.update(piece)
                        parts.append(piece) if keep_text else None
                        at, end = e, e
                        removed += e - a
                    elif e > end:
                        removed += e - end
                        at = end = e
                kept.update(memoryview(body)[at:])
                row = [t, sha, removed, spans, kept.hexdigest()] + ([b"".join([*parts, body[at:]])] if keep_text else [])
                yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, (_, kind) in zip(row, fields)], [n for n, _ in fields])

    return affected.mapInArrow(run, "text long, sha string, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text)


def removal_report(docs: DataFrame, doc_id: str, text: str, length: int = LENGTH, together: int = TOGETHER) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of each row."""
    rows, affected = repeated_intervals(docs, doc_id, text, length, together)
    cut = materialise(_cut(affected, False).dropDuplicates(["text", "sha"]), "cut")
    whole = F.coalesce(F.col("n") > 1, F.lit(False))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.join(cut, ["text", "sha"], "left").select(
        F.col("id").alias("doc_id"), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, none).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, doc_id: str, text: str, length: int = LENGTH) -> DataFrame:
    """``doc_id`` and ``kept``, the bytes that are left of each text."""
    rows, affected = repeated_intervals(docs, doc_id, text, length)
    cut = materialise(_cut(affected, True).dropDuplicates(["text", "sha"]), "cut")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    left = rows.join(cut, ["text", "sha"], "left").select("id", "sha", "kept", (F.coalesce(F.col("n") > 1, F.lit(False))).alias("whole")).distinct()
    source = docs.select(F.col(doc_id).alias("id"), F.sha2(body, 256).alias("sha"), body.alias("body"))
    return source.join(left, (source["id"].eqNullSafe(left["id"])) & (source["sha"] == left["sha"])).select(
        source["id"].alias("doc_id"), F.when(F.col("whole"), F.lit(b"")).otherwise(F.coalesce("kept", "body")).alias("kept"))
